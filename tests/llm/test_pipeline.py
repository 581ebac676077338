"""Every stage on its own input, held against a plain version of its rule."""

import corpus_pipeline
import pytest
from conftest import SF

from lociweave.llm import decontamination, jaccard_join, mixing, quality
from lociweave.storage import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        kept = written(stage(spark, docs, SF), "stage")
        out.append((docs, kept))
        docs = kept
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(stages):
    assert all(after.columns == COLUMNS for _, after in stages[:-1])


def test_quality_stage_keeps_what_scores_well(spark, stages):
    before, after = stages[0]
    scored = quality.score_documents(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(after) == ids(scored.where("score >= 0.7")) and 0 < after.count() < before.count()


def test_one_document_of_each_group_stays(stages):
    before, after = stages[1]
    found = jaccard_join.near_duplicate_components(before, words=5, percent=80)
    assert ids(after) == ids(found.where("doc_id = component_id"))
    texts = [r.text for r in after.collect()]
    assert len(texts) == len(set(texts))


def test_contaminated_documents_go(spark, stages):
    before, after = stages[2]
    hit = decontamination.find_benchmark(before, spark.read.parquet(f"{SF}/benchmark.parquet")).where("n_hit > 0")
    assert ids(after) == sorted(set(ids(before)) - set(ids(hit)))


def test_mixing_leaves_no_document_out(stages):
    before, after = stages[3]
    assert set(ids(after)) == set(ids(before)) and ids(after) == ids(mixing.mix_sources(before))


def test_tokens_hold_every_document(stages):
    before, after = stages[4]
    rows = after.collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert {i for r in rows for i in r.doc_ids} == set(ids(before.where("text <> ''")))


def test_run_gives_the_last_stage(spark, stages):
    assert corpus_pipeline.run(spark, SF).columns == stages[-1][1].columns
