"""The corpus operators over the driver's tables, with the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .conversations import damaged, repair_report, repaired
from .decontaminate import contamination
from .fingerprints import compare_with_edited
from .hostrules import STATISTICS, judged
from .importance import resampled
from .lexical import ranked
from .licenses import license_scan
from .mixing import taken_words
from .packing import packed
from .sharding import SHARDS, shard_rows
from .simhash import near_duplicates
from .suffixes import repeated_spans
from .warc import derivatives, responses

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {
    "op1_source_mixing": oracles.MIXING,
    "op3_stratified_shards": oracles.SHARDING,
    "op8_host_rules": oracles.HOST_RULES,
    "op9_warc_derivatives": oracles.WARC,
    "op10_suffix_array_dedup": oracles.SUFFIXES,
    "op11_lexical_search": oracles.LEXICAL,
    "op12_conversation_repair": oracles.CONVERSATIONS,
    "op13_benchmark_decontamination": oracles.DECONTAMINATION,
}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


@query
def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return taken_words(documents(spark, sf_dir).select("doc_id", "source", "text"))


@query
def op2_bottom_k_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each text and its edited text, and how alike they are."""
    return compare_with_edited(documents(spark, sf_dir).select("doc_id", "text"))


@query
def op3_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal row counts, each with the mixture of the whole."""
    rows = documents(spark, sf_dir).select(
        "doc_id", "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return shard_rows(rows, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's SimHash fingerprint and near-duplicate component."""
    found = near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                        "component_id")


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 512 to 8192 words."""
    return packed(documents(spark, sf_dir).select("doc_id", "text"))


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, tags and expressions of each document."""
    rows = documents(spark, sf_dir).select("doc_id", license_scan(F.col("text")).alias("found"))
    return rows.select("doc_id", "found.*")


@query
def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that importance resampling towards those labelled good keeps."""
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1 AND toxic = 0").select("doc_id")
    return resampled(documents(spark, sf_dir).select("doc_id", "text"), good)


@query
def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's statistics, its own failures, and the verdict with its host's."""
    found = judged(documents(spark, sf_dir).select("doc_id", "source", "text"), by_document=True)
    return found.select("doc_id", *STATISTICS, "base_failed", "kept")


@query
def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages."""
    return derivatives(responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))


@query
def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document keeps when passages of 50 bytes that an earlier one holds are cut out."""
    found = repeated_spans(documents(spark, sf_dir).select("doc_id", "text"), span=50)
    kept = F.coalesce("kept", F.lit(b""))
    return found.select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.length(kept)).alias("n_removed"),
        F.size("span_starts").cast("long").alias("n_spans"),
        F.sha2(kept, 256).alias("kept_sha256"))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item."""
    return ranked(documents(spark, sf_dir).select("doc_id", "text"), benchmark(spark, sf_dir))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of all conversations, damaged first."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair_report(repaired(damaged(given)), given)


@query
def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each document that stand in a window of ten words of a benchmark item."""
    found = contamination(documents(spark, sf_dir).select("doc_id", "text"), benchmark(spark, sf_dir))
    hit = F.aggregate("hit_words", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).cast("long").alias("sign")),
                      lambda a, x: F.struct((a["sum"] + a["sign"] * x).alias("sum"), (-a["sign"]).alias("sign")))
    return (found.withColumn("n_hit", hit["sum"])
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")))
