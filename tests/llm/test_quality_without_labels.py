"""The quality stage where no model can be fitted."""

from lociweave.llm import quality


def test_all_rows_stay_without_a_model(spark):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(8)], "doc_id long, text string")
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert sorted(r.doc_id for r in quality.keep_good(docs, empty).collect()) == list(range(8))
    one = spark.createDataFrame([(i, 1) for i in range(8)], "doc_id long, quality int")
    assert sorted(r.doc_id for r in quality.keep_good(docs, one).collect()) == list(range(8))
