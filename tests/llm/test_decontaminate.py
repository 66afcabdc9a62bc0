"""Benchmark decontamination against a brute-force version, over odd rows and in several blocks."""

import hashlib

import pytest

from playlake.llm import decontaminate
from playlake.llm.queries import QUERIES
from tests.llm.conftest import COLUMNS, PASSAGE, odd_rows

ITEMS = [(1, "X " + PASSAGE.replace(" ", "-").upper()), (2, "one two"), (3, None), (4, "  "), (5, "É" * 70), (6, "a " * 40),
         (None, "before it the quick"), (2, "one two"), (7, PASSAGE), (8, "v0x0 v1x0 v2x0 v3x0 v4x0 v5x0 v6x0 v7x0 v8x0 v9x0 v10x0")]


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def terms_of(text):
    out, word = [], ""
    for c in lowered(text) + " ":
        if c.isdigit() and c.isascii() or "a" <= c <= "z" or ord(c) > 127:
            word += c
        else:
            out += [word] if word else []
            word = ""
    return out


def brute(text, items, width=10):
    words = terms_of(text)
    hit, names = set(), set()
    for name, test in items:
        test = terms_of(test)
        for k in range(max(len(test) - width + 1, min(len(test), 1))):
            window = test[k:k + width]
            for i in range(len(words) - len(window) + 1):
                if words[i:i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    names |= {str(name)} - {"None"}
    return len(words), hit, sorted(names)


@pytest.fixture
def tests_(spark):
    return spark.createDataFrame(ITEMS, "item_id int, text string")


def short(rows):
    return [r for r in rows if len(r[1] or "") < 7000]


def found(rows):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.n_words,
                   tuple(x for a, b in zip(r.hit_words[::2], r.hit_words[1::2], strict=True) for x in range(a, b)), tuple(r["items"])) for r in rows)


@pytest.mark.parametrize("set_windows", [decontaminate.SET_WINDOWS, 20])
def test_contamination_equals_brute_force(spark, clashing, tests_, set_windows):
    docs = clashing.where("text is null or length(text) < 7000")
    got = found(decontaminate.contamination(docs, tests_, set_windows=set_windows).collect())
    want = []
    for i, text, *_ in short(odd_rows()):
        n, hit, names = brute(text, ITEMS)
        want.append((i is None, i or 0, text or "", n, tuple(sorted(hit)), tuple(names)))
    assert got == sorted(want)
    assert any(w[4] for w in want)


def test_long_texts_and_slices(spark, odd, tests_, monkeypatch):
    from playlake.llm import terms

    whole = {r.doc_id: (r.n_words, len(r.hit_words)) for r in decontaminate.contamination(odd, tests_).collect()}
    assert whole[12] == (30_000, 2) and whole[14] == (30_000, 2)
    for slice_ in (7, 64):
        monkeypatch.setattr(terms, "SLICE", slice_)
        for text in (b"", b"...", b"abc", b"a b " * 30, b"x" * 700 + b" yy " + b"z" * 64, "é ß".encode() * 9):
            begin, end, hashes = terms.terms(text)
            assert [text[a:b].decode() for a, b in zip(begin, end, strict=True)] == terms_of(text.decode())
            assert len({(h, text[a:b]) for a, b, h in zip(begin, end, hashes, strict=True)}) == len(set(hashes.tolist()))


def test_spans_or_documents_go(spark, clashing, tests_):
    docs = clashing.where("text is null or length(text) < 7000")
    kept = decontaminate.decontaminated(docs, tests_, documents=True)
    spans = decontaminate.decontaminated(docs, tests_)
    assert kept.columns == docs.columns == spans.columns and spans.dtypes == docs.dtypes
    clean = [(r[0], r[1]) for r in short(odd_rows()) if not brute(r[1], ITEMS)[1]]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted([(r[0], r[1]) for r in kept.collect()], key=key) == sorted(clean, key=key)
    cut = {r[0]: (r[1], r[4]) for r in spans.where("doc_id between 4 and 11").collect()}
    assert cut[4] == (None, 3) and cut[5] == ("", 0) and cut[7] == ("", 0)
    # "before it the quick" stands in document 8 once its text runs on, and goes with the passage
    assert cut[8] == (" after", 6) and cut[9] == ("elsewhere  again and on", 23)
    assert cut[11] == ("é" * 70, 1)  # É is beyond A-Z


def test_no_documents_and_no_items(spark, empty, odd, tests_):
    assert decontaminate.contamination(empty, tests_).count() == 0
    assert decontaminate.contamination(odd, tests_.limit(0)).where("size(hit_words) > 0").count() == 0


def test_query_on_a_fixture(spark, tmp_path, tests_):
    rows = short(odd_rows())
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    tests_.write.parquet(f"{tmp_path}/benchmark.parquet")
    for r in QUERIES["op13_benchmark_decontamination"](spark, str(tmp_path)).collect():
        if r.doc_id is not None and r.doc_id != 12:
            n, hit, names = brute(next(x[1] for x in rows if x[0] == r.doc_id), ITEMS)
            assert r[1:] == (n, len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit))
