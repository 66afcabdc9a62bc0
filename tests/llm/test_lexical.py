"""Ranked lexical search against scores worked out one by one, over odd rows and in several blocks."""

import math
from collections import Counter

import numpy as np
import pytest
import zstandard

from playlake.llm import lexical
from tests.llm.conftest import PASSAGE, odd_rows
from tests.llm.test_decontaminate import terms_of

ITEMS = [(1, PASSAGE + " the the"), (2, "W3 w5 w7 w7"), (3, None), (4, " .. "), (None, "one a"), (5, "é" * 70), (2, "W3 w5 w7 w7"),
         (6, "v1x1 V2x2 a"), (7, "nowhere")]


def brute(rows, items, top):
    docs = [(r[0], Counter(terms_of(r[1]))) for r in rows]
    n_docs = sum(1 for _, d in docs if d)
    length = sum(sum(d.values()) for _, d in docs)
    having = Counter(t for _, d in docs for t in d)
    out = []
    for item, text in items:
        wanted, scores = Counter(terms_of(text)), []
        for doc_id, tf in docs:
            n = sum(tf.values())
            m = 100 - 25 + (25 * n * n_docs) // length
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * having[t] + 1)))
                        * (1_000_000_000 * tf[t] // (1000 * tf[t] + 12 * m)) for t, times in wanted.items() if tf[t])
            scores += [(-score, doc_id is None, doc_id or 0)] if score > 0 else []
        out += [(item, k, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scores)[:top], 1)]
    return Counter(out)


@pytest.mark.parametrize(("top", "block_terms"), [(20, 1 << 20), (3, 1 << 20), (1, 10)])
def test_ranks_equal_brute_force(spark, clashing, top, block_terms):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = lexical.ranked(clashing, items, top, block_terms)
    assert Counter(map(tuple, got.collect())) == brute(odd_rows(), ITEMS, top)


def test_nothing_to_search_or_to_find(spark, odd, empty):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    for docs, wanted in ((empty, items), (odd, items.limit(0)), (odd.where("text is null"), items)):
        none = lexical.ranked(docs, wanted)
        assert none.count() == 0 and none.dtypes == [("item_id", "int"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_a_sketch_never_says_less_than_the_profile(spark, odd):
    rows = lexical.index(odd).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        unpack = zstandard.ZstdDecompressor().decompress
        terms, counts = np.frombuffer(r.terms, np.uint64), np.frombuffer(unpack(r.counts), np.uint32)
        assert counts.sum() == r.n
        sketch = np.frombuffer(unpack(r.sketch), np.uint8)
        width = len(sketch) // lexical.ROWS
        sketch = sketch.reshape(lexical.ROWS, width)
        for row in range(lexical.ROWS):
            assert (lexical.COUNTS[sketch[row][lexical._coordinates(terms, row, width)]] >= counts).all()


def test_few_documents_are_scored_exactly(spark, monkeypatch):
    docs = [(i, " ".join(f"t{(i * 31 + k * k) % 5003}" for k in range(60)), "en", "a", 0) for i in range(2000)]
    queries = lexical.Queries([(0, "t3 t5 t7 t11"), (1, docs[77][1])])
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"doc_id": d[0], "text": d[1]} for d in docs])
    indexed = list(lexical._indexed(iter([batch])))
    having = next(lexical._having(iter(indexed), queries.vocabulary))
    queries.weigh(2000, 120_000, dict(zip(having["term"].to_pylist(), having["docs"].to_pylist(), strict=True)))
    made, plain = [], lexical.Search.__init__
    monkeypatch.setattr(lexical.Search, "__init__", lambda self, *a: (plain(self, *a), made.append(self))[0])
    found = next(lexical._search(iter(indexed), queries, 20, pa.int64())).to_pylist()
    assert Counter((r["item_id"], r["doc_id"], r["score"]) for r in found) == Counter(
        (i, d, s) for i, _, d, s in brute(docs, [(0, "t3 t5 t7 t11"), (1, docs[77][1])], 20))
    assert made[0].scored < 1000  # of 4000
