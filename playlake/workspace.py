"""Where intermediate tables go, and how independent ones are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder for one intermediate table.

    It lies below ``spark.checkpoint.dir``, which on a cluster is shared storage.
    Without that setting only a local session gets a temporary folder: on a
    cluster the executors could not see each other's files there.
    """
    base = spark.conf.get(SETTING, None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError(f"set {SETTING} to a shared folder before running on {master!r}")
        base = tempfile.mkdtemp(prefix="playlake-")
    return f"{base.rstrip('/')}/playlake/{name}-{uuid.uuid4().hex}"


def at_once(*writes: Callable[[], Any]) -> list:
    """Run independent writes side by side, so that one's last tasks leave no cluster idle."""
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        return [job.result() for job in [pool.submit(write) for write in writes]]
