"""Quality rules by host: failures are counted per domain, shrunk, and joined back to documents.

Each rule fails some documents. A host's rate of failures says more about the documents that
remain than one document does, but small hosts have wild rates; so rates are drawn towards the
mean of all hosts by a beta prior that is fitted to the hosts themselves (matching the mean and
the variance of their rates). A host is bad if a drawn rate is above ``max_rate``.

``kept_documents`` also decides on single documents: one that fails a rule which doesn't reject by
itself goes, unless its host's drawn rate for that rule lies far below what the prior expects.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .frames import give_back, in_bytes, spread, stored, take

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
MAX_SYMBOLS = 10  # per cent of the words
MAX_DUP_LINES = 10  # equal lines
MAX_RATE = 0.9
CLEARED = 3  # standard deviations of the prior below its mean
SYMBOLS = b"#*$%&|<>"

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a run of ``width`` words found twice or more."""
    runs = list(zip(*[words[i:] for i in range(width)], strict=False))
    if len(set(runs)) == len(runs):
        return 0
    times = Counter(runs)
    inside = bytearray(len(words))
    for i, run in enumerate(runs):
        if times[run] > 1:
            inside[i:i + width] = b"\1" * width
    return sum(inside)


def text_statistics(text: bytes) -> tuple[int, int, int, int, int]:
    """The ``STATISTICS`` of a text in UTF-8."""
    words = text.split()  # of bytes: at ASCII blanks alone
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    blanks = int(seen[9:14].sum() + seen[32])
    characters = len(text) - int(seen[0x80:0xC0].sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), characters - blanks, int(seen[list(SYMBOLS)].sum()),
            len(lines) - len(set(lines)), repeated_words(words))


_STRUCT = StructType([StructField(name, LongType()) for name in STATISTICS])


@F.arrow_udf(_STRUCT)
def _statistics(texts: pa.Array) -> pa.Array:
    rows = [text_statistics(t or b"") for t in in_bytes(texts)]
    give_back()
    columns = zip(*rows, strict=True) if rows else [()] * len(STATISTICS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(STATISTICS))


def rules() -> dict[str, Column]:
    """The rules by name, true where a document fails; the first two reject it by themselves."""
    words = F.col("n_words")
    return {
        "short": words < MIN_WORDS,
        "repeating": 100 * F.col("n_repeat_words") > MAX_REPEATED * words,
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOLS * words,
        "lines": F.col("n_dup_lines") > MAX_DUP_LINES,
    }


REJECTING = ("short", "repeating")
DOUBTFUL = ("symbols", "lines")


def host_rates(failures: DataFrame, names: list[str]) -> DataFrame:
    """For each ``host`` its documents, and for each rule the failures and the drawn rate.

    With mean m and variance v of the hosts' rates, the prior weighs as much as
    m (1 - m) / v - 1 documents, between 1 and 1000 (1000 where all rates are equal). A host whose
    drawn rate is below ``low``, ``CLEARED`` standard deviations of the prior below its mean, is
    ``cleared`` of a rule.
    """
    hosts = stored(failures.groupBy("host").agg(
        F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(f"failed_{r}") for r in names]), "hosts")
    rate = {r: F.col(f"failed_{r}") / F.col("n") for r in names}
    moments = hosts.agg(*[F.avg(rate[r]).alias(f"m_{r}") for r in names],
                        *[F.var_pop(rate[r]).alias(f"v_{r}") for r in names]).first()  # one row
    drawn = []
    for r in names:
        m, v = moments[f"m_{r}"] or 0.0, moments[f"v_{r}"] or 0.0
        weight = min(max(m * (1 - m) / v - 1, 1.0), 1000.0) if v else 1000.0
        drawn_rate = (F.col(f"failed_{r}") + m * weight) / (F.col("n") + weight)
        low = m - CLEARED * (m * (1 - m) / (weight + 1)) ** 0.5
        drawn += [drawn_rate.alias(f"rate_{r}"), (drawn_rate < low).alias(f"cleared_{r}")]
    return hosts.select("*", *drawn)


def judged(docs: DataFrame, host: str = "source", max_rate: float = MAX_RATE,
           rest: str | None = None, by_document: bool = False) -> DataFrame:
    """Statistics and verdict of every row: ``doc_id``, the ``STATISTICS``, the rules (true:
    failed), ``base_failed``, ``host_failed``, ``kept``; with ``rest`` also the input row, as a
    struct of that name. With ``by_document`` documents that fail a ``DOUBTFUL`` rule of which their
    host is not cleared are not ``kept`` either.

    A null or blank text has no words and fails as short. A null host is a host of its own.
    Repeated rows are judged like others, each one counts. Null ids don't matter. An empty table
    gives an empty one.
    """
    checks = rules()
    table = take(docs, "doc_id", "text", host, rest=rest)
    carried = [rest] if rest else []
    stats = table.select("doc_id", F.col(host).alias("host"), *carried, _statistics("text").alias("s"))
    flagged = stored(stats.select("doc_id", "host", *carried, "s.*")
                     .select("*", *[c.alias(r) for r, c in checks.items()]), "judged")
    rates = host_rates(flagged, list(checks))
    worst = F.greatest(*[F.col(f"rate_{r}") for r in checks])
    bad = rates.where(worst > max_rate).select(F.col("host").alias("bad_host"), F.lit(True).alias("host_failed"))
    base = F.col(REJECTING[0]) | F.col(REJECTING[1])
    doubted = F.lit(False)
    if by_document:
        cleared = [f"cleared_{r}" for r in DOUBTFUL]
        free = rates.where(F.greatest(*cleared)).select(F.col("host").alias("free_host"), *cleared)
        flagged = flagged.join(free, F.col("host").eqNullSafe(F.col("free_host")), "left").drop("free_host")
        for r in DOUBTFUL:
            doubted = doubted | (F.col(r) & ~F.coalesce(f"cleared_{r}", F.lit(False)))
    joined = flagged.join(bad, F.col("host").eqNullSafe(F.col("bad_host")), "left").drop("bad_host")
    return (joined.withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
            .withColumn("base_failed", base).withColumn("kept", ~base & ~F.col("host_failed") & ~doubted))


def kept_documents(docs: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """The rows of ``docs`` that pass, also ``by_document``; all columns as they are, cases as for ``judged``."""
    return judged(docs, host, max_rate, rest="rest", by_document=True).where("kept").select(*spread("rest", docs.columns))
