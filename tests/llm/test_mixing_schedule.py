"""Mixtures against a plain scheduler that looks at all released blocks in every slot."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lociweave.llm import mixing


def plain_schedule(parts, blocks):
    """(source, block) by slot until each source has had its blocks."""
    period, taken, slots = sum(parts), [set() for _ in parts], []
    while any(len(own) < n for own, n in zip(taken, blocks, strict=True)):
        released = []
        for k, p in enumerate(parts):
            j = 0
            while j * period // p <= len(slots):
                if j not in taken[k]:
                    released.append((-(-(j + 1) * period // p), k, j))
                j += 1
        due, k, j = min(released)
        assert len(slots) < due
        taken[k].add(j)
        slots.append((k, j))
    return slots


def plain_mixture(rows, parts, size):
    """rows: the doc_ids of each source in order.  (doc_id, source number, epoch, block, slot, position)."""
    slots, out = plain_schedule(parts, [-(-len(own) // size) for own in rows]), []
    for slot, (k, j) in enumerate(slots):
        for i in range(size):
            epoch, rank = divmod(j * size + i, len(rows[k]))
            if epoch == 0 or slot < len(slots) - 1:
                out.append((rows[k][rank], k, epoch, j, slot, slot * size + i))
    return sorted(out, key=lambda r: r[-1])


@pytest.mark.parametrize("parts", [[1], [3, 3, 1], [50, 49, 1], [7, 1, 13, 2, 2, 40, 35], [97, 89, 83, 1, 1]])
def test_schedule_takes_the_released_block_of_the_earliest_deadline(parts):
    blocks = [max(1, 3 * p // max(1, min(parts))) % 60 + 1 for p in parts]
    want = plain_schedule(parts, blocks)
    slots = mixing.schedule(parts)
    assert [next(slots) for _ in want] == want


@pytest.mark.parametrize(("weights", "size"), [({"a": 0.5, "b": 0.3, None: 0.2}, 8), ({"a": 1, "b": 1, None: 1}, 5), ({"a": 0.61, "b": 0.38, None: 0.01}, 3), (None, 4)])
def test_mixture_equals_plain_scheduling(spark, weights, size):
    r = random.Random(11)
    docs = spark.createDataFrame([(k, r.choice(["a", "a", "a", "b", "b", None])) for k in range(160)] + [(900, "b")], "doc_id long, source string")
    names = [None, "a", "b"]
    ordered = docs.orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    rows = [[d.doc_id for d in ordered if d.source == s] for s in names]
    exact = mixing.integer_weights(weights or {s: len(own) ** mixing.TEMPER for s, own in zip(names, rows, strict=True)})
    want = plain_mixture(rows, [exact[s] for s in names], size)
    got = mixing.mix_sources(docs, weights, block_rows=size).orderBy("position").collect()
    assert [(d.doc_id, names.index(d.source), d.epoch, d.block, d.slot, d.position) for d in got] == want


def test_one_source_of_one_row_and_equal_weights(spark):
    one = spark.createDataFrame([(7, "a")], "doc_id long, source string")
    assert [(d.doc_id, d.epoch, d.block, d.slot, d.position) for d in mixing.mix_sources(one).collect()] == [(7, 0, 0, 0, 0)]
    tied = spark.createDataFrame([(k, "ab"[k % 2]) for k in range(8)], "doc_id long, source string")
    got = mixing.mix_sources(tied, {"a": 1, "b": 1}, block_rows=2).orderBy("position").collect()
    assert [d.source for d in got] == list("aabbaabb")
