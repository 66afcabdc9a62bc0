"""Incremental loads: every new file once, committed batch by batch.

Structured Streaming keeps track of the files. Every handler may see a batch again after
a failure and therefore replaces what it wrote for that batch number instead of adding to it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import plays
from ..plans import star
from ..schemas import CORRUPT, FAULT, LOG_FILE, SONGPLAY, STAGING_EVENTS, TIME, USERS, Table
from ..sources import (
    FAULTY,
    current_version,
    delete_folder,
    expire_versions,
    log_faults,
    parse_json_lines,
    read_parquet,
    read_version,
    refuse_faults,
    write_parquet,
    write_version,
)
from ..workspace import at_once, scratch_path
from .buckets import BUCKETS, expire_buckets, merge_into_buckets, read_buckets
from .compaction import FILE_BYTES, append_batch, compact, read_batches

Handler = Callable[[DataFrame, int], None]

#: Lines that are dealt together; about a block of the shuffle's compression.
_RUN_BITS = 6

_BATCH = T.StructField("batch", T.LongType())
_SEQ = T.StructType([STAGING_EVENTS.schema[c] for c in star.ARRIVAL])

_COMMIT = T.StructType([_BATCH])
ID_END = Table("songplay_end", T.StructType([T.StructField("next_id", T.LongType())]))

OWNER = Table("owner", T.StructType([T.StructField("id", T.StringType())]))

QUARANTINED = Table(
    "quarantine",
    T.StructType([T.StructField(c, T.StringType()) for c in (FAULT, CORRUPT, "row")]),
)

USER_STATES = Table(
    "user_states",
    T.StructType([
        *USERS.schema.fields,
        T.StructField("first_seq", _SEQ),
        T.StructField("last_seq", _SEQ),
    ]),
    key=USERS.key,
)


def _dealt(lines: DataFrame) -> DataFrame:
    """Lines of text dealt over all cores in runs: neighbours are alike, and compress well together."""
    run = F.shiftright(F.monotonically_increasing_id(), _RUN_BITS).alias("run")
    return lines.select("value", run).repartition(lines.sparkSession.sparkContext.defaultParallelism, "run").drop("run")


def each_new_file(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    checkpoint: str,
    handler: Handler,
    *,
    pattern: str | None = None,
    files_per_batch: int | None = None,
    spread: bool = False,
) -> None:
    """Hand all files of JSON lines not seen before to ``handler(rows, batch number)`` and stop.

    The rows have the columns of ``schema`` and ``_corrupt_record``, the text of a malformed line:
    the handler decides what becomes of those. ``checkpoint`` remembers the files; a run that finds
    no new ones does nothing, and a batch whose handler failed is handed over again.

    ``spread`` deals the lines over all cores before they are parsed. For compressed files, each of
    which is read in one task, and parsing takes much longer than reading.
    """

    def parsed(lines: DataFrame, batch: int) -> None:
        handler(parse_json_lines(_dealt(lines) if spread else lines, schema), batch)

    reader = spark.readStream.option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    (
        reader.text(source)
        .writeStream.foreachBatch(parsed)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _owner(spark: SparkSession, base: str) -> str | None:
    last = current_version(spark, f"{base}/owner")
    return None if last is None else read_version(spark, f"{base}/owner", OWNER, last).first()["id"]


def claim(spark: SparkSession, out: str, checkpoint: str) -> None:
    """Tie an output to the progress folder that numbers its batches.

    With another progress folder numbering begins anew, and batch 0 would replace the output's
    batch 0: that is refused. Both folders keep the same id.
    """
    mine, theirs = _owner(spark, checkpoint), _owner(spark, out)
    if theirs is not None and mine != theirs:
        raise ValueError(f"{out} holds batches of another progress folder than {checkpoint}")
    if theirs is None:
        name = mine or uuid.uuid4().hex
        for base in ([] if mine else [checkpoint]) + [out]:
            write_version(spark.createDataFrame([(name,)], OWNER.schema), f"{base}/owner", 0)


def merge_users_batch(log: DataFrame, base: str, batch: int, buckets: int = BUCKETS) -> None:
    """Merge a batch of log lines into the user states below ``base``, bucket by bucket.

    The batch is reduced to one state per user before it meets the stored ones, and only buckets
    with users of the batch are rewritten, or added to where they are large. The states read are those of an earlier batch, so a
    replay gives the same states again.
    """
    merge_into_buckets(star.user_states(log), base, batch, USER_STATES, star.merge_user_states, buckets)


def users_now(spark: SparkSession, base: str, up_to: int | None = None) -> DataFrame:
    """The users table as of the last merged batch, or of the last one up to a batch number."""
    return read_buckets(spark, base, USER_STATES, up_to, star.merge_user_states).select(USERS.columns)


def _append_numbered(fact: DataFrame, out: str, batch: int) -> None:
    """Append fact rows with ids that go on from the batch before, whose end was noted."""
    spark = fact.sparkSession
    ends = f"{out}/songplay_end"
    last = current_version(spark, ends, before=batch)
    start = 1 if last is None else read_version(spark, ends, ID_END, last).first()["next_id"]
    scratch = f"{out}/_scratch"
    numbered = star.keyed_songplays(fact, "dense", start=start, scratch=f"{scratch}/{uuid.uuid4().hex}")
    append_batch(numbered, f"{out}/songplay", batch)
    delete_folder(spark, scratch)
    rows = spark.read.schema(SONGPLAY.schema).parquet(f"{out}/songplay/batch={batch}")
    write_version(
        rows.agg((F.count("*") + start).alias("next_id")), ends, batch
    )


def load_activity_files(
    spark: SparkSession,
    source: str,
    catalog: DataFrame,
    out: str,
    checkpoint: str,
    *,
    files_per_batch: int | None = None,
    pattern: str | None = "*.json",
    bad: str = "fail",
    buckets: int = BUCKETS,
    spread: bool = False,
) -> dict[str, DataFrame]:
    """New activity files to users, time and songplay below ``out``, under the ``keyed`` rules.

    ``bad`` says what becomes of malformed lines and of lines without a required column, as in the
    other loads. ``'fail'``: the batch fails before any table has it, and is tried again by the next
    run. ``'quarantine'``: they go to ``out/quarantine/staging_events`` as part of their batch, with
    the reason, and the others are loaded.

    A batch counts once all three tables have it: what is returned ends with the last batch
    noted in ``out/commits``. ``out`` belongs to ``checkpoint`` from the first run on (``claim``).

    ``catalog`` must be complete before: a play whose song arrives later stays unresolved.
    Song play ids go on from the rows of earlier batches. ``spread``: see ``each_new_file``.
    """

    def handler(raw: DataFrame, batch: int) -> None:
        session = raw.sparkSession
        rows = log_faults(raw)
        append_batch(refuse_faults(rows) if bad == "fail" else rows, f"{out}/events", batch)
        checked = T.StructType([*STAGING_EVENTS.schema, *(T.StructField(c, T.StringType()) for c in FAULTY)])
        stored = session.read.schema(checked).parquet(f"{out}/events/batch={batch}")
        if bad == "quarantine":
            row = F.to_json(F.struct(*STAGING_EVENTS.columns)).alias("row")
            faulty = stored.filter(F.col(FAULT).isNotNull()).select(*FAULTY, row)
            append_batch(faulty, f"{out}/quarantine/{STAGING_EVENTS.name}", batch)
        log = plays(stored.filter(F.col(FAULT).isNull()).drop(*FAULTY))
        times = star.time_dimension(
            star.log_times(log, precision="ms"), distinct=False, style="mon0"
        )
        if not kept:  # reduced once: a batch's cost must not be the whole catalog's
            write_parquet(reduced, songs)
            kept.append(read_parquet(session, songs, reduced.schema))
        fact = star.songplays(log, kept[0], match="all", precision="ms")
        at_once(
            partial(merge_users_batch, log, f"{out}/users", batch, buckets),
            partial(append_batch, times, f"{out}/time", batch),
            partial(_append_numbered, fact, out, batch),
        )
        write_version(session.createDataFrame([(batch,)], _COMMIT), f"{out}/commits", batch)
        # the batch before stays for readers that have begun, and for a replay of this one
        for versioned in ("songplay_end", "commits"):
            expire_versions(session, f"{out}/{versioned}", keep=3)
        expire_buckets(session, f"{out}/users", keep=3)

    if bad not in ("fail", "quarantine"):
        raise ValueError(f"bad must be 'fail' or 'quarantine', not {bad!r}")
    claim(spark, out, checkpoint)
    songs, reduced, kept = scratch_path(spark, "songs"), star.first_songs(catalog), []
    each_new_file(
        spark,
        source,
        LOG_FILE,
        checkpoint,
        handler,
        pattern=pattern,
        files_per_batch=files_per_batch,
        spread=spread,
    )
    delete_folder(spark, songs)
    return activity_tables(spark, out)


def activity_tables(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables of ``load_activity_files`` as of the last batch that all of them have."""
    last = current_version(spark, f"{out}/commits")
    if last is None:
        raise ValueError(f"no completed batch below {out}")
    return {
        USERS.name: users_now(spark, f"{out}/users", last),
        TIME.name: read_batches(spark, f"{out}/time", TIME, last),
        SONGPLAY.name: read_batches(spark, f"{out}/songplay", SONGPLAY, last),
    }


def quarantined(spark: SparkSession, out: str) -> DataFrame:
    """What ``load_activity_files(bad='quarantine')`` has set aside, up to the last batch that is done:
    ``fault``, the malformed line, and the row as JSON."""
    last = current_version(spark, f"{out}/commits")
    if last is None:
        raise ValueError(f"no completed batch below {out}")
    return read_batches(spark, f"{out}/quarantine/{STAGING_EVENTS.name}", QUARANTINED, last)


def compact_activity(spark: SparkSession, out: str, file_bytes: int = FILE_BYTES) -> dict[str, int]:
    """Compact the time and songplay batches that are done, sorted by their time; how many of each."""
    last = current_version(spark, f"{out}/commits")
    if last is None:
        raise ValueError(f"no completed batch below {out}")
    return {
        table.name: compact(spark, f"{out}/{table.name}", table, last, order=["start_time"], file_bytes=file_bytes)
        for table in (TIME, SONGPLAY)
    }
