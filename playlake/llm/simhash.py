"""Near-duplicate documents by SimHash fingerprints, joined with themselves in a binary trie.

Fingerprints that differ in at most ``budget`` bits agree in at least one of ``budget + 1``
blocks, so each fingerprint takes part once per block, in the group that has its block value in
front. A group is the trie of its fingerprints: from the root paired with itself, node pairs are
taken down together one bit at a time, differing bits add up, and a pair goes no further once it
has more than the budget. Groups are dealt over tasks; one too large for a task is entered
further down, at its node pairs instead of its root.

A task reports each fingerprint's smallest linked partner in its group (a spanning forest, not
the pairs), and connected components join the groups' findings.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .frames import give_back, in_bytes, spread, stored, take

BUDGET = 3
SHINGLE = 3
SEED = 42
#: A group of more fingerprints is entered at its node pairs, 4 bits deeper per 16 times the size.
GROUP = 1 << 18
DEPTHS = (4, 8, 12)  # groups larger than 4,096 times GROUP are entered no deeper than the last
PAIRS_AT_ONCE = 1 << 20


def shingle_hashes(text: bytes, width: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``width`` words, joined by blanks; A-Z count as a-z.

    Fewer words give the hash of the whole sequence, none gives no hash.
    """
    words = text.lower().split()  # of bytes: both look at ASCII alone
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    count = len(words) - width + 1
    bounds = zip(starts[:count].tolist(), ends[width - 1:].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], seed) for a, b in bounds), np.uint64, count)


def simhash(text: bytes, width: int = SHINGLE) -> int:
    """The 64 bits that are set in over half of the shingle hashes, as a signed number."""
    hashes = shingle_hashes(text, width)
    if not len(hashes):
        return 0
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i:i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: Column, width: int = SHINGLE) -> Column:
    """The fingerprint of a text; a null or blank one has fingerprint zero."""

    @F.arrow_udf(LongType())
    def of(texts: pa.Array) -> pa.Array:
        prints = pa.array([simhash(t, width) if t else 0 for t in in_bytes(texts)], pa.int64())
        give_back()
        return prints

    return of(text)


def _flips(bits: int, budget: int) -> list[int]:
    """All values of ``bits`` bits with at most ``budget`` of them set."""
    return [sum(1 << b for b in chosen)
            for n in range(min(bits, budget) + 1) for chosen in combinations(range(bits), n)]


def _grouped(prints: DataFrame, budget: int) -> DataFrame:
    """Each fingerprint once per block: ``turn`` and ``block`` are its group, ``key`` is turned
    so that the block stands in front; large groups are entered at node pairs (``low``, ``flip``)."""
    blocks = budget + 1
    width = 64 // blocks
    turned = [F.struct(F.lit(t).alias("turn"),
                       (F.shiftleft("print", t * width)
                        .bitwiseOR(F.shiftrightunsigned("print", 64 - t * width)) if t else
                        F.col("print")).alias("key")) for t in range(blocks)]
    dealt = (prints.select(F.explode(F.array(*turned)).alias("at")).select("at.*")
             .withColumn("block", F.shiftrightunsigned("key", 64 - width)))
    # at most blocks * 2**width rows, whatever the input: safe to broadcast
    large = (dealt.groupBy("turn", "block").count().where(F.col("count") > GROUP)
             .select("turn", "block", F.least(4 * F.ceil(F.log(16.0, F.col("count") / GROUP)), F.lit(DEPTHS[-1]))
                     .cast("int").alias("depth")))
    dealt = dealt.join(F.broadcast(large), ["turn", "block"], "left")
    root = F.array(F.struct(F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("flip")))
    entered = root
    for depth in DEPTHS:
        next_bits = F.shiftrightunsigned("key", 64 - width - depth).bitwiseAND(F.lit((1 << depth) - 1))
        pairs = F.transform(F.array(*[F.lit(f).cast("long") for f in _flips(depth, budget)]),
                            lambda f, v=next_bits: F.struct(F.least(v, v.bitwiseXOR(f)).alias("low"), f.alias("flip")))
        entered = F.when(F.col("depth") >= depth, pairs).otherwise(entered)
    return (dealt.withColumn("entry", F.explode(entered))
            .select("turn", "block", "key", F.coalesce("depth", F.lit(0)).alias("depth"), "entry.low", "entry.flip"))


class Trie:
    """Sorted fingerprints, and the spanning forest of the links found so far."""

    def __init__(self, keys: np.ndarray, budget: int):
        self.keys, self.budget = keys, budget
        self.root = np.arange(len(keys))
        self.ones: dict[int, np.ndarray] = {}

    def up_to(self, level: int) -> np.ndarray:
        """Number of keys before each place whose bit ``level`` is set."""
        if level not in self.ones:
            bit = (self.keys >> np.uint64(63 - level)) & np.uint64(1)
            self.ones[level] = np.append(np.uint32(0), np.cumsum(bit, dtype=np.uint32))
        return self.ones[level]

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            high, low = np.maximum(x, y), np.minimum(x, y)
            apart = high != low
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, high[apart], low[apart])
            while True:
                further = self.root[self.root]
                if (further == self.root).all():
                    break
                self.root = further

    def walk(self, pairs: np.ndarray, level: int) -> None:
        """Takes node pairs (rows: a from, a to, b from, b to, differing bits) down from a level."""
        todo = [(pairs, level)]
        while todo:
            pairs, level = todo.pop()
            if pairs.shape[1] > PAIRS_AT_ONCE:
                half = pairs.shape[1] // 2
                todo += [(pairs[:, half:], level), (pairs[:, :half], level)]
                continue
            pairs = self.apart(pairs)
            alo, ahi, blo, bhi, bits = pairs
            few = ((ahi - alo) * (bhi - blo) <= 8) | (level == 64)
            self.compare(pairs[:, few])
            alo, ahi, blo, bhi, bits = pairs[:, ~few]
            if not len(alo):
                continue
            ones = self.up_to(level)
            amid = ahi - (ones[ahi].astype(np.int64) - ones[alo])
            bmid = bhi - (ones[bhi].astype(np.int64) - ones[blo])
            same = (alo == blo) & (ahi == bhi)
            next_ = np.concatenate([
                np.stack([alo, amid, blo, bmid, bits]), np.stack([amid, ahi, bmid, bhi, bits]),
                np.stack([alo, amid, bmid, bhi, bits + 1]),
                np.stack([amid, ahi, blo, bmid, bits + 1])[:, ~same]], axis=1)
            alive = (next_[0] < next_[1]) & (next_[2] < next_[3]) & (next_[4] <= self.budget)
            todo.append((next_[:, alive], level + 1))

    def apart(self, pairs: np.ndarray) -> np.ndarray:
        """Without the pairs whose fingerprints are all joined already: they'd add nothing."""
        change = np.append(0, np.cumsum(np.append(False, self.root[1:] != self.root[:-1])))
        alo, ahi, blo, bhi, _ = pairs
        joined = ((change[ahi] == change[alo + 1]) & (change[bhi] == change[blo + 1])
                  & (self.root[alo] == self.root[blo]) & ((alo != blo) | (ahi - alo > 1)))
        return pairs[:, ~joined]

    def compare(self, pairs: np.ndarray) -> None:
        alo, ahi, blo, bhi, _ = pairs
        n = (ahi - alo) * (bhi - blo)
        if not n.sum():
            return
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = np.repeat(bhi - blo, n)
        a, b = np.repeat(alo, n) + step // wide, np.repeat(blo, n) + step % wide
        near = (a != b) & (np.bitwise_count(self.keys[a] ^ self.keys[b]) <= self.budget)
        self.link(a[near], b[near])


def _linked(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """The forest of all groups of one partition."""
    rows = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if rows is None or not rows.num_rows:
        return
    width = 64 // (budget + 1)
    turn, block, low, flip, depth = (rows[c].to_numpy().astype(np.int64)
                                     for c in ("turn", "block", "low", "flip", "depth"))
    key = rows["key"].to_numpy().view(np.uint64)
    order = np.lexsort((key, flip, low, block, turn))
    turn, block, low, flip, depth, key = (x[order] for x in (turn, block, low, flip, depth, key))
    edge = np.append(True, np.diff(turn) | np.diff(block) | np.diff(low) | np.diff(flip)).astype(bool)
    start = np.flatnonzero(edge)
    stop = np.append(start[1:], len(key))
    trie = Trie(key, budget)
    for d in np.unique(depth[start]).tolist():
        at = start[depth[start] == d]
        to = stop[depth[start] == d]
        mixed = flip[at] != 0  # the two nodes of a pair: keys with the next bits low, or not
        front = np.uint64(64 - width - d)
        side = (key >> front) & np.uint64((1 << d) - 1)
        firsts = np.append(0, np.cumsum(side == low.view(np.uint64)))
        middle = at + firsts[to] - firsts[at]
        pairs = np.stack([at, np.where(mixed, middle, to), np.where(mixed, middle, at), to,
                          np.bitwise_count(flip[at].view(np.uint64)).astype(np.int64)])
        pairs = pairs[:, (pairs[0] < pairs[1]) & (pairs[2] < pairs[3])]
        trie.walk(pairs, width + d)
    found = np.flatnonzero(trie.root != np.arange(len(key)))
    back = (turn[found] * width).astype(np.uint64)

    def turned_back(k: np.ndarray) -> np.ndarray:
        return np.where(back == 0, k, (k >> back) | (k << ((np.uint64(64) - back) & np.uint64(63)))).view(np.int64)

    yield pa.RecordBatch.from_arrays([pa.array(turned_back(key[found])),
                                      pa.array(turned_back(key[trie.root[found]]))], names=["a", "b"])


def linked_fingerprints(prints: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Links (``a``, ``b``) whose closure joins all fingerprints (column ``print``, each once)
    that differ in at most ``budget`` bits."""
    usual = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(usual, (budget + 1) * prints.count() // (4 * GROUP))  # what a task holds is bounded
    grouped = _grouped(prints, budget).repartition(parts, "turn", "block", "low", "flip")
    return grouped.mapInArrow(lambda batches: _linked(batches, budget), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """The smallest node (``root``) that each linked ``node`` can reach.

    Each round a node takes the smallest label around it, passes it on to the node its own label
    names, and then jumps to the label of its label. Every round is stored.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node"))
                    .agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("root")), "labels")
    while True:
        own = labels.select(F.col("node").alias("a"), F.col("root").alias("mine"))
        near = labels.select(F.col("node").alias("b"), F.col("root").alias("found"))
        seen = both.join(near, "b").join(own, "a").where("found < mine")
        offers = (seen.select(F.explode(F.array("a", "mine")).alias("node"), F.col("found").alias("root"))
                  .union(labels))
        taken = offers.groupBy("node").agg(F.min("root").alias("root"))
        above = taken.select(F.col("node").alias("root"), F.col("root").alias("top"))
        nearer = stored(taken.join(above, "root").select("node", F.col("top").alias("root")), "labels")
        if nearer.join(labels, ["node", "root"], "left_anti").isEmpty():
            return nearer
        labels = nearer


def _labeled(different: DataFrame, budget: int) -> DataFrame:
    """Adds ``label`` to each different fingerprint (column ``print``): the one its component is named by."""
    labels = components(linked_fingerprints(different.select("print"), budget))
    return (different.join(labels.withColumnRenamed("node", "print"), "print", "left")
            .withColumn("label", F.coalesce("root", "print")).drop("root"))


def near_duplicates(docs: DataFrame, width: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """For each row its ``fingerprint`` (signed) and ``component_id``: the smallest ``doc_id``
    that can be reached over links between fingerprints differing in at most ``budget`` bits.

    Returns ``doc_id``, ``fingerprint`` and ``component_id``. A null or blank text has
    fingerprint zero and is linked like any other. Null ids are passed over in the smallest id;
    where a component has no other, its id is null. Repeated rows stay, in one component. Texts
    count whole, however long: the votes of a long one are summed up in slices. An empty table gives
    an empty one. Further columns of ``docs`` don't matter.
    """
    printed = stored(take(docs, "doc_id", "text")
                     .select("doc_id", fingerprint(F.col("text"), width).alias("print")), "simhash")
    labeled = _labeled(printed.groupBy("print").agg(F.min("doc_id").alias("first_id")), budget)
    least = labeled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    return (printed.join(labeled.select("print", "label").join(least, "label"), "print")
            .select("doc_id", F.col("print").alias("fingerprint"), "component_id"))


def one_of_each(docs: DataFrame, width: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """The rows of ``docs`` that stay when of each near-duplicate component only one row is kept, that
    with the smallest ``doc_id``; all columns as they are.

    Rows are judged one by one: where rows share an id, each goes with its own text's component, and
    the text with the smaller hash stays. A null id comes after all others. Of repeated rows one
    stays. A null or blank text has fingerprint zero. An empty table gives an empty one.
    """
    key = [F.col("doc_id"), F.xxhash64("text").alias("tie")]
    rows = stored(take(docs, "doc_id", "text").select(*key, fingerprint(F.col("text"), width).alias("print"))
                  .groupBy("doc_id", "tie", "print").agg(F.count("*").alias("n")), "simhash")
    labeled = _labeled(rows.select("print").distinct(), budget)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")
    named = stored(rows.join(labeled, "print"), "simhash-labels")
    # stored, so that the join below has nothing but shuffled rows, and can split a large group
    first = stored(named.groupBy("label").agg(F.min(order).alias("first")), "simhash-first")
    judged = (named.join(first, "label")
              .withColumn("stays", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tie") == F.col("first.tie"))))
    # those that go, and those that stay once of several times; all others pass as they are
    changed = stored(judged.where("NOT stays OR n > 1")
                     .select(F.col("doc_id").alias("of_id"), F.col("tie").alias("of_tie"), "stays"), "simhash-changed")
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("tie") == F.col("of_tie"))
    table = take(docs, "doc_id", "text", rest="rest").select(*key, "rest")
    kept = table.join(changed.drop("stays"), same, "left_anti")
    repeated = changed.where("stays")
    if not repeated.isEmpty():
        once = table.join(repeated.drop("stays"), same, "left_semi").dropDuplicates(["doc_id", "tie"])
        kept = kept.unionByName(once)
    return kept.select(*spread("rest", docs.columns))
