"""The pipeline as a whole."""

import __spark_entry__ as entry
import corpus_pipeline
from countersign.llm.queries import table

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, DATA, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, DATA)
        assert after.dtypes == docs.dtypes, name
        after = after.cache()
        assert 0 < after.count() <= docs.count()
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_columns_with_names_of_the_stages_own(spark):
    docs = table(spark, DATA, "documents").limit(20).selectExpr(
        "*", "1 AS private_kinds", "2 AS private_kinds_", "'x' AS component", "0.5D AS score", "3 AS kept"
    )
    hidden = dict(corpus_pipeline.STAGES)["private_data"](spark, docs, DATA)
    assert hidden.dtypes == docs.dtypes and hidden.count() == 20
    assert {(r.private_kinds, r.private_kinds_) for r in hidden.collect()} == {(1, 2)}


def test_empty_table(spark):
    docs = table(spark, DATA, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        assert out.count() == 0
        docs = out if "text" in out.columns else docs


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in names} and "pipeline" in names


def test_texts_that_stay_are_not_shuffled(spark):
    """Only rows that may go meet the anti join; rows without an id and unlike ones stay."""
    import corpus_pipeline

    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, words, 1), (2, words, 2), (3, "other words here", 3), (None, words, 4), (None, None, 5), (2, words, 6), (4, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, may_go int")
    left = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert left.columns == docs.columns
    assert sorted(r.may_go for r in left.collect()) == [1, 3, 4, 5, 7]
    assert "Union" in left._jdf.queryExecution().optimizedPlan().toString()
