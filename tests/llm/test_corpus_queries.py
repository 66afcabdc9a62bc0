"""The corpus queries against their SQL on the smallest tables, and the pipeline."""

from collections import Counter

import pytest

import corpus_pipeline
from playlake.llm import hostrules, mixing, packing, simhash, suffixes
from playlake.llm.queries import ORACLE, QUERIES
from tests.check_oracle import connect, difference
from tests.llm.conftest import odd_rows
from tests.llm.test_corpus_operators import brute_components, brute_kept, brute_print, words_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, db, name):
    assert difference(QUERIES[name](spark, SF), db, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_returns_every_document(spark, name):
    rows = QUERIES[name](spark, SF).select("doc_id").distinct()
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_stages_keep_the_columns_of_documents(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, SF)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert made.dtypes == docs.dtypes, name
            made.count()


def test_pipeline_equals_brute_force_on_a_small_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    # rules: no host of the tables fails as a whole, none clears a rule
    stats = {r[0]: hostrules.text_statistics((r[1] or "").encode()) for r in rows}
    rows = [r for r in rows if (s := stats[r[0]])[0] >= 50 and 100 * s[4] <= 50 * s[0] and 100 * s[2] <= 10 * s[0] and s[3] <= 10]
    root = brute_components({brute_print(r[1]) for r in rows})
    first = {}
    for r in rows:
        first[root[brute_print(r[1])]] = min(r[0], first.get(root[brute_print(r[1])], r[0]))
    rows = [r for r in rows if first[root[brute_print(r[1])]] == r[0]]
    kept = {i: b.decode("utf-8", "ignore") for i, b in brute_kept(rows, suffixes.SPAN)}
    words = Counter()
    for r in corpus_pipeline.run(spark, SF).collect():
        words[r.doc_id] += r.n_words
    cut = spark.createDataFrame([(r[0], kept[r[0]], *r[2:]) for r in rows], docs.schema)
    want = {r.doc_id: r.taken for r in mixing.taken_words(cut).collect() if r.taken}
    assert +words == Counter(want)
    assert all(words[i] <= 2 * len(words_of(text)) for i, text in kept.items())
    assert packing.LENGTHS and simhash.BUDGET == 3 and len(odd_rows()) > 0
