"""Play counts by time window from a stream of activity files, late and repeated lines included."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import plays
from ..schemas import LOG_FILE, Table, layout
from ..sources import typed_events

PLAY_COUNTS = Table(
    "play_counts",
    layout("""
        window_start timestamp_ntz
        level string
        plays bigint
    """),
    key=("window_start", "level"),
)

#: Two lines with the same values here are one line, delivered twice.
LINE = ("sessionId", "itemInSession", "ts", "userId")


def windowed_counts(lines: DataFrame, window: str, late: str) -> DataFrame:
    """Plays by window of their time and level; of repeated lines one counts.

    ``lines`` is a stream (or a table) of log lines. A line older than the newest one seen by more
    than ``late`` is passed over. A repeated line is known as one for as long, so what is kept of the
    stream is the lines of that time and the open windows.
    """
    at = F.timestamp_millis(F.col("ts"))
    timed = plays(lines).withColumn("at", at).withWatermark("at", late)
    # a table has all lines at once: a repeat is one whenever it comes
    once = timed.dropDuplicatesWithinWatermark([*LINE]) if lines.isStreaming else timed.dropDuplicates([*LINE])
    counted = once.groupBy(F.window("at", window), "level").agg(F.count("*").alias("plays"))
    return counted.select(
        F.to_timestamp_ntz(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss")).alias("window_start"), "level", "plays")


def load_windowed_counts(
    spark: SparkSession,
    source: str,
    out: str,
    checkpoint: str,
    *,
    window: str = "1 day",
    late: str = "2 days",
    files_per_batch: int | None = None,
    pattern: str | None = "*.json",
) -> DataFrame:
    """Counts of the windows that are closed, from all files not seen before; returns all so far.

    A window is written once, when no line of it can come any more; ``checkpoint`` keeps the open ones
    for the next run, and the list of files written, so a batch that is done again adds nothing.
    """
    reader = spark.readStream.schema(LOG_FILE).option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    (
        windowed_counts(typed_events(reader.json(source)), window, late)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(PLAY_COUNTS.schema).parquet(out)
