"""File scans. Every reader takes an explicit schema, so no pass over the data is spent on inference.

Paths may be folders, globs or any Hadoop file system URI, one or several.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CONSOLIDATED_CSV, CORRUPT, EVENT_CSV


def read_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    *,
    recursive: bool = True,
    pattern: str | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """JSON lines from every file at any depth, compressed or not; with ``pattern`` only from
    files whose name matches.

    A malformed line gives a row of NULLs; with ``keep_corrupt`` its text is kept in
    ``_corrupt_record`` so that it can be set aside (see ``operators.split_corrupt``). Lines of
    blanks are passed over, and a line that holds an array gives a row per object in it.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if not keep_corrupt:
        return reader.schema(schema).json(paths)
    # Parsed from text lines: a JSON scan would refuse to return the malformed text alone.
    return parse_json_lines(reader.text(paths), schema)


def parse_json_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Lines of text (column ``value``) as rows of ``schema`` and ``_corrupt_record``, the text of a
    malformed line; as ``read_json`` with ``keep_corrupt``, also for streams."""
    fields = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    one = F.from_json("value", fields, {"columnNameOfCorruptRecord": CORRUPT})
    many = F.from_json("value", T.ArrayType(schema))
    whole = many.isNotNull() & ~F.exists(many, lambda r: r.isNull())
    listed = F.transform(many, lambda r: F.struct(
        *(r[f.name].alias(f.name) for f in schema), F.lit(None).cast("string").alias(CORRUPT)))
    broken = F.array(F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema), F.col("value").alias(CORRUPT)))
    rows = F.when(F.col("value").rlike(r"^\s*\["), F.when(whole, listed).otherwise(broken)).otherwise(F.array(one))
    return lines.filter(F.col("value").rlike(r"\S")).select(F.explode(rows).alias("r")).select("r.*")


def _read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    pattern: str | None,
    multiline: bool,
    keep_corrupt: bool,
) -> DataFrame:
    fields = [*schema.fields, *([T.StructField(CORRUPT, T.StringType())] if keep_corrupt else [])]
    reader = (
        spark.read.schema(T.StructType(fields))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("recursiveFileLookup", True)
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.csv(paths)


def read_event_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    pattern: str | None = None,
    multiline: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Event CSV files, columns bound by position, one header line per file, all text.

    ``multiline`` accepts line breaks inside quoted fields, at the price of reading each
    file in a single task. Without it such a record comes apart into lines of the wrong
    length; ``keep_corrupt`` keeps those in ``_corrupt_record``.
    """
    return _read_csv(spark, paths, EVENT_CSV, pattern, multiline, keep_corrupt)


def read_consolidated(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    pattern: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """The consolidated event file set written by ``sinks.write_consolidated``."""
    return _read_csv(spark, paths, CONSOLIDATED_CSV, pattern, multiline, False)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet dataset under its declared types.

    Without a schema Spark would guess the types of directory partitions and turn
    the id ``007`` into the number 7.
    """
    return spark.read.schema(schema).parquet(path)


def with_arrival(rows: DataFrame, name: str = "arrival") -> DataFrame:
    """A file scan with a column that orders its rows: by file, then by place in the file.

    To be called on the scan itself, before any shuffle.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.withColumn(name, place)


def scan_report(
    spark: SparkSession, rows: DataFrame, path: str, *, pattern: str | None = None
) -> DataFrame:
    """One row per input file with its row count; files without rows count 0.

    ``rows`` is a scan of ``path``. The file list is the one that any scan makes before it begins; no file is opened for it, and
    no names are passed to Python. It has files of zero bytes too, which no scan gives a row of. The counts are combined map-side, so one huge file costs no more than its own scan.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    found = reader.load(path)
    sizes = found.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"), F.lit(0).alias("n"))
    counts = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    jvm = spark._jvm
    names = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(found._jdf.inputFiles())
    listed = DataFrame(spark._jsparkSession.createDataset(names, jvm.org.apache.spark.sql.Encoders.STRING()).toDF(), spark)
    # the listing writes local names with an empty host, the scan without
    name = F.regexp_replace("value", "^file:///", "file:/").alias("file")
    zero = F.lit(0).cast("bigint")
    counted = (sizes.unionByName(counts.withColumn("bytes", zero))
               .unionByName(listed.select(name, zero.alias("bytes"), F.lit(0).alias("n"))))
    return counted.groupBy("file").agg(F.max("bytes").alias("bytes"), F.sum("n").alias("rows"))
