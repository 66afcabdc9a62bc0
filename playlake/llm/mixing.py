"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks of words.

The mix is a row of slots. Slot n has the van der Corput point of n (its binary digits behind the
point, in reverse), and the cumulated shares of the sources tell which source owns that point: so
every stretch of the mix, however short, is close to the target weights. The r-th slot of a source
takes block r of that source: its documents, shuffled by a seeded hash, form one stream of words,
which is cut into blocks of equal size and starts again when it is used up.

DataFrame functions only. Documents are numbered in two steps (see ``frames.running``), so a
source with most of the rows still fills many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import WORD, in_ranges, key_digits, running, shuffled_key, spread, stored, take

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
BLOCK_WORDS = 4096
SEED = "mix"
_POINT_BITS = 40
_SLOTS_PER_PART = 1 << 16
_CELLS_PER_ROW = 1 << 16


def n_words(text: Column) -> Column:
    """Words between ASCII blanks; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                   epochs: int = EPOCHS) -> DataFrame:
    """For each source (null is one) its ``source_size`` and its ``target``, in words.

    Sources in order of their code points, null last, get the weights in turn, again and again,
    and share ``share`` times the size of all. None gets more than ``epochs`` times its size: what
    is above goes to the others by weight, until none is above. So a target is the smaller of that
    limit and weight times a common level, and the level is the highest that
    (all - limits of the sources before) / (weights from here on) reaches when the sources stand
    in the order in which they meet their limit.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = [F.col("source").asc_nulls_last()]
    ranked = running(in_ranges(by_source, named, "sources"), [], "part", named, "rank")
    weighted = ranked.select(
        "source", "source_size", (F.col("rank") + 1).cast("long").alias("source_no"),
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * float(epochs)).alias("limit"))
    filling = [F.col("fill"), F.col("source_no")]
    table = in_ranges(weighted.withColumn("fill", F.col("limit") / F.col("weight")), filling, "filling")
    sums = table.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    before = running(running(table, [], "part", filling, "limits", F.col("limit")), [], "part", filling, "weights", F.col("weight"))
    level = (F.lit(float(sums["size"] or 0) * share) - F.col("limits")) / (F.lit(float(sums["weight"] or 0)) - F.col("weights"))
    highest = before.agg(F.max(level).alias("level")).first()["level"]
    return table.select("source", "source_no", "source_size",
                        F.least("limit", F.col("weight") * F.lit(highest).cast("double")).alias("target"))


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots of the mix: ``slot``, ``source_no``, ``block``, and the words ``from`` to ``to``
    of the source's stream, going on behind its end with its beginning.

    A source whose share is too small for any slot gets one at the end.
    """
    spark = targets.sparkSession
    total = targets.agg(F.sum("target").alias("t")).first()["t"] or 0.0
    slots = max(1, int(-(-total // block_words)))
    # whole words: their sums are exact, so every share begins where the one before ends
    some = targets.select("source_no", F.floor("target").cast("long").alias("words")).where("words >= 1")
    words = some.agg(F.sum("words").alias("w")).first()["w"] or 1
    by_number = [F.col("source_no")]
    shares = (running(in_ranges(some, by_number, "shares"), [], "part", by_number, "first", F.col("words"))
              .select("source_no", "words", (F.col("first") / F.lit(words)).alias("low"),
                      ((F.col("first") + F.col("words")) / F.lit(words)).alias("high")))
    cell = lambda x: F.least(F.floor(x * F.lit(slots)), F.lit(slots - 1)).cast("long")
    # as many cells as slots, and rows of cells. A source stands in each row that is all its own, and
    # cell by cell in the rows it begins and ends in; so one source has few entries, however many slots
    reach = (shares.select("source_no", "low", "high", cell(F.col("low")).alias("a"), cell(F.col("high")).alias("b"))
             .withColumn("row_a", F.expr(f"a div {_CELLS_PER_ROW}")).withColumn("row_b", F.expr(f"b div {_CELLS_PER_ROW}")))
    rows = (reach.where("row_b - row_a > 1")
            .select("source_no", F.explode(F.sequence(F.col("row_a") + 1, F.col("row_b") - 1)).alias("row")))
    first_cells = F.sequence("a", F.least(F.col("b"), (F.col("row_a") + 1) * _CELLS_PER_ROW - 1))
    last_cells = F.when(F.col("row_b") > F.col("row_a"), F.sequence(F.col("row_b") * _CELLS_PER_ROW, F.col("b"))).otherwise(
        F.array().cast("array<bigint>"))
    cells = (reach.select("source_no", "low", "high", first_cells.alias("f"), last_cells.alias("l"))
             .select("source_no", "low", "high", F.explode(F.concat("f", "l")).alias("cell")))
    point = (F.conv(F.reverse(F.lpad(F.bin("id"), _POINT_BITS, "0")), 2, 10).cast("double")
             / F.lit(float(1 << _POINT_BITS)))
    points = (spark.range(slots).select(F.col("id").alias("slot"), point.alias("x"))
              .withColumn("cell", cell(F.col("x"))))
    owned = (points.withColumn("row", F.expr(f"cell div {_CELLS_PER_ROW}")).join(rows, "row").select("slot", "source_no")
             .unionByName(points.join(cells, "cell").where("low <= x AND x < high").select("slot", "source_no")))
    ranked = running(owned.withColumn("part", F.floor(F.col("slot") / _SLOTS_PER_PART)),
                     ["source_no"], "part", [F.col("slot")], "block").drop("part")
    missed = (shares.join(owned.select("source_no").distinct(), "source_no", "left_anti")
              .select((F.col("source_no") + F.lit(slots - 1)).cast("long").alias("slot"), "source_no",
                      F.lit(0).cast("long").alias("block")))
    ranked = stored(ranked.unionByName(missed), "slots")
    counts = ranked.groupBy("source_no").agg(F.count("*").alias("blocks"))
    cut = (shares.select("source_no", "words").join(counts, "source_no")
           .withColumn("each", F.expr("words div blocks")).withColumn("more", F.expr("words % blocks")))
    start = lambda b: b * F.col("each") + F.least(b, F.col("more"))
    return (ranked.join(cut, "source_no")
            .select("slot", "source_no", "block", "blocks", "each", "more", "words",
                    start(F.col("block")).alias("from"), start(F.col("block") + 1).alias("to")))


def streamed(sized: DataFrame, targets: DataFrame, seed: str = SEED) -> DataFrame:
    """Adds to each row (``doc_id``, ``source``, ``size``, ``tie``) its source's ``source_no``,
    ``source_size`` and ``target``, and the place of its first word in the shuffled stream."""
    named = targets.withColumnRenamed("source", "of_source")
    key = F.when(F.col("doc_id").isNull(), shuffled_key(seed, "doc_id", "tie")).otherwise(shuffled_key(seed, "doc_id"))
    placed = (sized.join(named, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
              .withColumn("key", key).withColumn("part", F.substring("key", 1, key_digits(sized.count()))))
    return running(placed, ["source_no"], "part",
                   [F.col("key"), F.col("size"), F.col("tie")], "start", F.col("size")).drop("key", "part")


def _row(table: DataFrame) -> Column:
    """A hash of all columns of a struct ``rest`` but maps, which have no hash."""
    plain = [f"rest.{f.name}" for f in table.schema["rest"].dataType if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*plain)


def _sized(docs: DataFrame) -> DataFrame:
    """Each row's id, source and size, a hash of its text (``tie``) and one of all its columns (``row``)."""
    table = take(docs, "doc_id", "source", "text", rest="rest")
    return table.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"),
                        _row(table).alias("row"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS,
        block_words: int = BLOCK_WORDS, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """Mixes all ``docs`` (``doc_id``, ``source``, ``text``); returns documents and pieces.

    Documents: each row's ``doc_id``, ``source``, ``size`` (words), ``source_no``, ``source_size``,
    ``target`` and ``start``, its place in its source's stream. Pieces: the mix itself, in the
    order of ``slot`` and ``from_word``: which ``words`` from ``from_word`` on of the document at
    (``source_no``, ``start``) it takes, and in which ``epoch``.

    A source's pieces add up to its target, rounded down, and no document is taken more than
    ``epochs`` times. A null source is a source of its own. A null or blank text has no words: it
    is listed, and nothing is taken from it. Null ids and repeated rows are rows like others. An
    empty table gives empty results. Reruns agree, as the order comes from hashes of the ids and,
    among equal ones, of the texts. Further columns don't matter.
    """
    sized = stored(_sized(docs), "sized")
    targets = stored(source_targets(sized, weights, share, epochs), "targets")
    slots = stored(schedule(targets, block_words), "schedule")
    placed = stored(streamed(sized, targets, seed), "streamed")
    cuts = slots.select("source_no", "blocks", "each", "more", "words").distinct().withColumnRenamed("words", "taken")
    reach = (placed.where("size > 0").join(cuts, "source_no")
             .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
             .withColumn("a", F.col("epoch") * F.col("source_size") + F.col("start"))
             .withColumn("b", F.least(F.col("a") + F.col("size"), F.col("taken")))
             .where("a < b"))
    big = F.col("more") * (F.col("each") + 1)  # the first blocks are one word longer
    block = lambda p: F.when(p < big, F.floor(p / (F.col("each") + 1))).otherwise(
        F.col("more") + F.floor((p - big) / F.greatest(F.col("each"), F.lit(1)))).cast("long")
    parts = (reach.withColumn("block", F.explode(F.sequence(block(F.col("a")), block(F.col("b") - 1))))
             .select("source_no", "start", "epoch", "a", "b", "block"))
    pieces = (parts.join(slots.select("slot", "source_no", "block", "from", "to"), ["source_no", "block"])
              .select("slot", "source_no", "start", "epoch",
                      (F.greatest("a", "from") - F.col("a")).alias("from_word"),
                      (F.least("b", "to") - F.greatest("a", "from")).alias("words")))
    return placed, pieces


def taken_words(docs: DataFrame, **settings: object) -> DataFrame:
    """What ``mix`` takes of each row: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``."""
    placed, pieces = mix(docs, **settings)
    sums = pieces.groupBy("source_no", "start").agg(F.sum("words").alias("taken"))
    return (placed.join(sums, ["source_no", "start"], "left")
            .select("doc_id", "size", "source_size", "target",
                    F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("taken")))


def first_words(text: Column, count: Column) -> Column:
    """A text up to the end of its ``count``-th word, blanks as they are."""
    blanks = r"[\x20\x09-\x0D]+"
    lead = F.when(text.rlike("^" + blanks), 1).otherwise(0)
    behind = F.element_at(F.split(text, blanks, (count + lead + 1).cast("int")), -1)
    return F.regexp_replace(F.substring(text, F.lit(1), F.length(text) - F.length(behind)), blanks + "$", "")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                    epochs: int = EPOCHS, block_words: int = BLOCK_WORDS, seed: str = SEED) -> DataFrame:
    """The mix as documents: a row of ``docs`` once for each epoch that takes words of it.

    What the pieces of ``mix`` take of a row in an epoch are its first words, as the blocks of a source
    follow each other without gaps: every document whole, but for the last of the source, whose text
    ends where the target does (``n_chars`` is set anew). All columns stay. Documents without words are
    not in the mix. Rows that are equal in all columns but maps are copies of one row. See ``mix`` for
    the other cases.
    """
    placed, pieces = mix(docs, weights, share, epochs, block_words, seed)
    taken = pieces.groupBy("source_no", "start", "epoch").agg(F.sum("words").alias("words"))
    each = stored(placed.where("size > 0").join(taken, ["source_no", "start"])
                  .select(F.col("doc_id").alias("of_id"), F.col("row").alias("of_row"), "epoch", "size", "words"), "taken")
    table = take(docs, "doc_id", "text", rest="rest")
    table = table.select("doc_id", "rest", _row(table).alias("row"))
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("row") == F.col("of_row"))
    repeated = stored(each.groupBy("of_id", "of_row", "epoch").count().where("count > 1")
                      .select("of_id", "of_row").distinct(), "repeated")
    if not repeated.isEmpty():  # each copy is listed by itself, so one of the rows stands for all
        table = (table.join(repeated, same, "left_anti")
                 .unionByName(table.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "row"])))
    at = docs.columns.index
    text = F.col(f"rest.c{at('text')}")
    cut = F.col("words") < F.col("size")
    changed = {"text": F.when(cut, first_words(text, F.col("words"))).otherwise(text)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = (F.when(cut, F.length(first_words(text, F.col("words"))).cast(docs.schema["n_chars"].dataType))
                              .otherwise(F.col(f"rest.c{at('n_chars')}")))
    return table.join(each, same).select(*spread("rest", docs.columns, **changed))
