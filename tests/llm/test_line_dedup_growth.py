"""States of the line dedup that grow far beyond their first batch."""

import pytest

from lociweave.llm import line_dedup


def dropped(state, frame):
    return sorted((r.doc_id, r.line) for r in state.dropped(line_dedup.line_keys(frame, "doc_id", "text", 20)).collect())


@pytest.mark.parametrize("shard_lines", [line_dedup.SHARD_LINES, 100])
def test_a_state_grows_many_times_and_shrinks_again(spark, monkeypatch, shard_lines):
    monkeypatch.setattr(line_dedup, "SHARD_LINES", shard_lines)
    text = lambda keys: "\n".join(f"a shared line of the corpus, number {k}" for k in keys)
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    small = [(i, text(range(5))) for i in range(3)]
    large = [(10 + i, text(range(400))) for i in range(3)]
    state = line_dedup.LineDedup(spark, shards=2).add(frame(small)).add(frame(large))
    assert (state.shards > 2) == (shard_lines == 100)
    assert dropped(state, frame(small + large)) == sorted([(i, k) for i in range(3) for k in range(5)] + [(10 + i, k) for i in range(2) for k in range(400)])
    state = state.delete(frame(large[1:]))
    assert dropped(state, frame(small + large[:1])) == sorted((i, k) for i in range(3) for k in range(5))
    state = state.delete(frame(large[:1]))
    assert dropped(state, frame(small)) == sorted((i, k) for i in range(2) for k in range(5))
