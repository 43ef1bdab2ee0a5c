import corpus_pipeline
from tidewatch.llm.common import store, table


def test_stages_take_effect(spark, small):
    docs = table(spark, small, "documents")
    counts, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, small), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] < counts[0]
    assert counts[1] >= 0.98 * counts[0]  # clean documents stay
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert {r.doc_id for r in rows.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_stages_on_odd_rows(spark, small, odd, none):
    for rows in (odd, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = store(stage(spark, rows, small), name)
            assert out.columns == rows.columns and out.count() <= rows.count()
