"""Staging: raw files to typed rows, once, before anything reads them twice."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clip_text, to_id
from ..schemas import CORRUPT, FAULT, LOG_FILE, SONG_FILE, STAGING_EVENTS, STAGING_SONGS, TEXT_WIDTH
from .readers import read_json


_STEP = re.compile(r"\.([^.\[\]']+)|\['([^'\]]+)'\]|\[(\d+)\]")


def _steps(path: str) -> list[str | int]:
    """The object keys and array positions of a path."""
    rest = path.removeprefix("$")
    rest = rest if rest[:1] in (".", "[") else f".{rest}"
    steps, at = [], 0
    while found := _STEP.match(rest, at):
        key, quoted, position = found.groups()
        steps.append(int(position) if position is not None else key or quoted)
        at = found.end()
    if not steps or at != len(rest):
        raise ValueError(f"not a path of object keys and array positions: {path!r}")
    return steps


def _variant_path(steps: Sequence[str | int]) -> str:
    return "$" + "".join(f"[{s}]" if isinstance(s, int) else f"['{s}']" for s in steps)


def _nested(tree: Mapping) -> T.StructType:
    return T.StructType([
        T.StructField(name, _nested(node) if isinstance(node, Mapping) else node)
        for name, node in tree.items()
    ])


def read_mapped_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    mapping: Mapping[str, tuple[str, T.DataType]],
    *,
    pattern: str | None = None,
) -> DataFrame:
    """JSON lines through a column map ``target: (json path, type)``.

    Paths are object keys, ``$.user.id`` or ``$['user']['id']``, and array positions,
    ``$.songs[0].title``. All of them are read in one parse of the line. Without positions they
    become one nested schema for the scan, which parses nothing else; with positions the line
    becomes one variant value that they are taken from. What isn't there, or isn't of the type, is
    NULL, and a malformed line a row of NULLs.
    """
    if any(isinstance(s, int) for path, _ in mapping.values() for s in _steps(path)):
        reader = spark.read.option("recursiveFileLookup", True)
        if pattern:
            reader = reader.option("pathGlobFilter", pattern)
        lines = reader.text(paths).filter(F.col("value").rlike(r"\S")).select(F.try_parse_json("value").alias("line"))
        return lines.select([
            F.try_variant_get("line", _variant_path(_steps(path)), kind.simpleString()).alias(target)
            for target, (path, kind) in mapping.items()
        ])
    tree: dict = {}
    columns = []
    for target, (path, kind) in mapping.items():
        *parents, leaf = steps = _steps(path)
        node = tree
        for step in parents:
            node = node.setdefault(step, {})
            if not isinstance(node, dict):
                raise ValueError(f"{path!r} goes through a key that another path reads as a value")
        if isinstance(node.get(leaf), dict) or node.get(leaf, kind) != kind:
            raise ValueError(f"{path!r} is mapped to two types")
        node[leaf] = kind
        columns.append(F.col(".".join(f"`{s}`" for s in steps)).alias(target))
    return read_json(spark, paths, _nested(tree), pattern=pattern).select(columns)


FAULTY = (FAULT, CORRUPT)


def _typed(
    df: DataFrame, schema: T.StructType, clip: bool, extra: Sequence[str] = ()
) -> DataFrame:
    def column(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, T.LongType):
            value = to_id(value)
        elif isinstance(field.dataType, T.StringType) and clip:
            value = clip_text(value, TEXT_WIDTH)
        return value.alias(field.name)

    return df.select([column(f) for f in schema] + list(extra))


def typed_events(rows: DataFrame, *, clip: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Raw log rows as ``staging_events`` rows; blank user ids become NULL. Columns to ``keep`` come along."""
    return _typed(rows, STAGING_EVENTS.schema, clip, keep)


def typed_songs(rows: DataFrame, *, clip: bool = True) -> DataFrame:
    """Raw catalog rows as ``staging_songs`` rows, over-long text clipped to the column width."""
    return _typed(rows, STAGING_SONGS.schema, clip)


def stage_events(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    clip: bool = False,
    pattern: str | None = None,
) -> DataFrame:
    """Activity files as ``staging_events`` rows; a malformed line fails the job that reads it."""
    raw = read_json(spark, paths, LOG_FILE, pattern=pattern, keep_corrupt=True)
    return typed_events(refuse_faults(with_fault(raw)), clip=clip)


def stage_songs(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    clip: bool = True,
    pattern: str | None = None,
) -> DataFrame:
    """Song files as ``staging_songs`` rows; a malformed line fails the job that reads it."""
    raw = read_json(spark, paths, SONG_FILE, pattern=pattern, keep_corrupt=True)
    return typed_songs(refuse_faults(with_fault(raw)), clip=clip)


def with_fault(
    rows: DataFrame, required: Sequence[str] = (), numbers: Sequence[str] = ()
) -> DataFrame:
    """Adds ``fault``: why a row can't be loaded, or NULL.

    A row is at fault if its line was malformed (``_corrupt_record``, where the scan kept it),
    a ``required`` column is NULL, or one of ``numbers`` holds text that is no whole number.
    """
    reasons = [F.when(F.col(c).isNull(), f"{c} must not be null") for c in required]
    reasons += [F.when(to_id(c).isNull(), f"{c} must be a whole number") for c in numbers]
    if CORRUPT in rows.columns:
        reasons.insert(0, F.when(F.col(CORRUPT).isNotNull(), "malformed line"))
    return rows.withColumn(FAULT, F.coalesce(*reasons, F.lit(None).cast("string")))


def refuse_faults(rows: DataFrame) -> DataFrame:
    """Rows of ``with_fault``; the job that reads them fails on the first one at fault."""
    told = F.raise_error(F.concat(F.lit("cannot load: "), F.col(FAULT))).cast("boolean")
    return rows.filter(F.when(F.col(FAULT).isNull(), True).otherwise(told)).drop(FAULT, CORRUPT)


def checked_events(
    spark: SparkSession, paths: str | Sequence[str], *, pattern: str | None = None
) -> DataFrame:
    """Activity files as ``staging_events`` rows with their ``fault`` and malformed lines."""
    return log_faults(read_json(spark, paths, LOG_FILE, pattern=pattern, keep_corrupt=True))


def log_faults(raw: DataFrame) -> DataFrame:
    """Parsed log lines as ``staging_events`` rows with their ``fault`` and malformed lines."""
    return _typed(with_fault(raw, STAGING_EVENTS.required), STAGING_EVENTS.schema, False, FAULTY)


def checked_songs(
    spark: SparkSession, paths: str | Sequence[str], *, pattern: str | None = None
) -> DataFrame:
    """Song files as ``staging_songs`` rows with their ``fault`` and malformed lines."""
    raw = read_json(spark, paths, SONG_FILE, pattern=pattern, keep_corrupt=True)
    return _typed(with_fault(raw, STAGING_SONGS.required), STAGING_SONGS.schema, True, FAULTY)
