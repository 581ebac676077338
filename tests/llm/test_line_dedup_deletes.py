"""Deletions of line dedup: what a state drops is what one built afresh from the rows that are left would drop."""

import random

import pytest

from lociweave.llm.line_dedup import LineDedup, line_keys

A, B, C, D = (f"a line that is long enough, number {k}" for k in "abcd")


def drops(state, frame):
    lines = line_keys(frame, "doc_id", "text", 20)
    return sorted((tuple(r) for r in state.dropped(lines).select("doc_id", "text_hash", "line").collect()), key=str)


def fresh(spark, rows):
    return LineDedup(spark).add(table(spark, rows))


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def agree(spark, state, rows, every):
    assert drops(state, table(spark, every)) == drops(fresh(spark, rows), table(spark, every))


def test_unknown_documents_can_be_deleted_and_added_later(spark):
    rows = [(1, A), (2, A)]
    state = fresh(spark, rows).delete(table(spark, [(3, A)])).add(table(spark, [(3, A)]))
    agree(spark, state, [*rows, (3, A)], [*rows, (3, A)])
    assert drops(state, table(spark, [*rows, (3, A)]))


def test_a_repeated_delete_changes_nothing(spark):
    rows = [(k, A) for k in (1, 2, 3, 4)]
    once = fresh(spark, rows).delete(table(spark, [(4, A)]))
    state = once.delete(table(spark, [(4, A)])).add(table(spark, [(4, A)]))
    agree(spark, state, rows, rows)
    assert len(drops(state, table(spark, rows))) == 3


def test_rows_of_one_document_go_one_by_one(spark):
    rows = [(1, A), (2, A), (3, A), (3, f"{A}\nanother text")]
    state = fresh(spark, rows).delete(table(spark, [(3, A)]))
    left = [rows[0], rows[1], rows[3]]
    agree(spark, state, left, rows)
    assert len(drops(state, table(spark, left))) == 2
    twice = fresh(spark, [*rows[:3], (3, A)])
    agree(spark, twice.delete(table(spark, [(3, A)])), rows[:3], rows)
    agree(spark, twice.delete(table(spark, [(3, A), (3, A), (3, A)])), rows[:2], rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_changes_equals_a_fresh_build(spark, seed):
    rng = random.Random(seed)
    texts = [A, B, f"{A}\n{A}", f"{A}\n{B}\n{C}", f"{C}\n{D}", "short", None]
    held, state = [], LineDedup(spark)
    for _ in range(5):
        added = [(rng.choice([None, 1, 2, 3, 4, 5, 6]), rng.choice(texts)) for _ in range(rng.randint(1, 6))]
        gone = [rng.choice([*held, *added, (rng.randrange(9), rng.choice(texts))]) for _ in range(rng.randint(0, 5))]
        state, held = state.add(table(spark, added)), held + added
        if gone:
            state = state.delete(table(spark, gone))
        for row in gone:
            if row in held:
                held.remove(row)
    every = [(k, t) for k in (None, 1, 2, 3, 4, 5, 6, 7, 8) for t in texts]
    agree(spark, state, held or [(0, "short")], every)
