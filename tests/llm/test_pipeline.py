import corpus_pipeline
from rows import DOCS
from test_near_dedup import brute

from slotwise.llm import queries, sql
from slotwise.llm.common import DOCUMENT_COLUMNS, stage

FOLDER = "/root/testdata/sf0.001"


def test_stages_decide_and_keep_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "minhash_near_dedup", "secret_scan", "packing"]
    kept = [docs]
    for _, function in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(function(spark, kept[-1], FOLDER)))
        assert tuple(kept[-1].columns) == DOCUMENT_COLUMNS
    counts = [d.count() for d in kept]
    assert counts[0] > counts[1] and counts[2] <= counts[1] and counts[3] <= counts[2] and counts[4] == counts[3]
    before = [(r.doc_id, r.text) for r in kept[2].collect()]
    alone = {i for i, (_, c) in brute(before, 5, 80).items() if i == c}
    assert {r.doc_id for r in kept[3].collect()} == alone
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept[4], FOLDER)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == alone


def test_stages_take_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, docs, FOLDER).count() == 0


def test_sql_belongs_to_queries():
    assert set(sql.oracle_sql()) <= set(queries.queries())


def test_sql_gives_the_same_rows(spark):
    from compare import connect, difference

    con = connect(FOLDER)
    for name, text in sql.oracle_sql().items():
        assert difference(queries.queries()[name](spark, FOLDER).toPandas(), con.execute(text).df()) is None
