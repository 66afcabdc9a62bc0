"""Documents that fail a rule which rejects only together with what is known of their host."""

import corpus_pipeline
from playlake.llm import hostrules
from tests.llm.conftest import COLUMNS

FINE = " ".join(f"w{i}" for i in range(80))
SF = "/root/testdata/sf0.01"


def test_symbols_and_lines_reject_unless_the_host_clears_them(spark):
    rows = [(i, f"{FINE} {i}" + " ##########" * (i % 100 < 20), "en", f"h{i % 1000 // 100}", 0) for i in range(1000)]
    rows += [(1000 + i, f"{FINE} {i}" + " ##########" * (i == 7), "en", "clean", 0) for i in range(4000)]
    rows += [(6000, FINE + "\nsame" * 12, "en", "h1", 0)]
    kept = {r.doc_id for r in hostrules.kept_documents(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert kept == {i for i in range(1000) if i % 100 >= 20} | set(range(1000, 5000))  # 1007: its host is cleared


def test_junk_of_the_tables_is_rejected_and_no_good_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    failing = {r.doc_id for r in hostrules.judged(docs).where("kept AND (symbols OR lines)").collect()}
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, SF).collect()}
    assert len(failing) == 68 and failing <= gone
    assert {labels[i] for i in failing if i in labels} == {0}
