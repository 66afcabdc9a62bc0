"""Results worked out by hand, which neither the operators' constants nor the SQL made of them can change."""

import duckdb
import pytest

from playlake.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import COLUMNS

WORDS = " ".join(f"w{i}" for i in range(60))  # 60 words, 10 of 2 and 50 of 3 characters


@pytest.fixture
def both(spark, tmp_path):
    """Runs a query and its SQL over some documents."""

    def run(name, docs):
        spark.createDataFrame(docs, COLUMNS).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        db = duckdb.connect()
        db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
        sql = db.execute(ORACLE[name])
        columns = [d[0] for d in sql.description]
        theirs = sorted(dict(sorted(zip(columns, r, strict=True))).items() for r in sql.fetchall())
        mine = sorted(dict(sorted(r.asDict().items())).items() for r in QUERIES[name](spark, str(tmp_path)).collect())
        return [dict(r) for r in mine], [dict(r) for r in theirs]

    return run


def test_statistics_and_verdicts(both):
    docs = [
        (1, WORDS, "en", "s", 0),
        (2, WORDS + "\nsame line\nsame line", "en", "s", 0),
        (3, WORDS + " #" * 7, "en", "s", 0),  # 7 symbols in 67 words: over a tenth
        (4, "a b c " * 20, "en", "s", 0),  # every word is in a window found twice
        (5, None, "en", "t", 0),
        (6, "just a few", "en", "t", 0),
    ]
    want = {
        1: (60, 170, 0, 0, 0, False, True),
        2: (64, 186, 0, 1, 0, False, True),
        3: (67, 177, 7, 0, 7, False, False),
        4: (60, 60, 0, 0, 60, True, False),
        5: (0, 0, 0, 0, 0, True, False),
        6: (3, 8, 0, 0, 0, True, False),
    }
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    for found in both("op8_host_rules", docs):
        assert {r["doc_id"]: tuple(r[n] for n in names) for r in found} == want


def test_targets_of_three_sources(both):
    # sizes 100, 60 and 40 with weights 5, 2 and 1 share 300: by weight 187.5, 75 and 37.5, none above twice its size
    docs = [(i, "w " * n, "en", s, 0) for i, (s, n) in enumerate([("a", 70), ("a", 30), ("b", 60), ("c", 40), ("c", 0)])]
    for found in both("op1_source_mixing", docs):
        assert {(r["source_size"], r["target"]) for r in found} == {(100, 187.5), (60, 75.0), (40, 37.5)}
        by_target = {t: sum(r["taken"] for r in found if r["target"] == t) for t in (187.5, 75.0, 37.5)}
        assert by_target == {187.5: 187, 75.0: 75, 37.5: 37}
    # one word of b: its target stops at 2, and what is left is shared by 5 to 1: 151.5 - 2 = 149.5
    docs = [(0, "w " * 60, "en", "a", 0), (1, "w", "en", "b", 0), (2, "w " * 40, "en", None, 0)]
    for found in both("op1_source_mixing", docs):
        target = {r["doc_id"]: r["target"] for r in found}
        assert target[1] == 2.0 and target[0] == 120.0 and target[2] == pytest.approx(29.5)


def test_passages_of_fifty_bytes(both):
    fifty = "0123456789" * 5
    docs = [(1, fifty, "en", "s", 0), (2, "x" + fifty + "y", "en", "s", 0), (3, "z" + fifty[:49], "en", "s", 0), (4, fifty + "y", "en", "s", 0)]
    for found in both("op10_suffix_array_dedup", docs):
        # of 4 the last 50 bytes, too: they start in 2
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in found} == {
            1: (50, 0, 0), 2: (52, 50, 1), 3: (50, 0, 0), 4: (51, 51, 1)}
