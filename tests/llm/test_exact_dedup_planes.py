"""What pass 1 of exact dedup exchanges."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lociweave.llm import exact_dedup

LOTS, WORDS, ROWS = 200, 4096, 16_384


@pytest.fixture(scope="module")
def keys(spark):
    h = F.xxhash64(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")))  # a third of all rows are alike
    rows = spark.range(ROWS).select(
        F.pmod(F.hash("id"), F.lit(LOTS)).alias("lot"), F.pmod(h, F.lit(WORDS)).alias("word"),
        F.shiftright(h, 32).bitwiseAND(63).cast("int").alias("bit_a"), F.shiftright(h, 38).bitwiseAND(63).cast("int").alias("bit_b"),
    )
    return rows


def test_planes_are_a_row_for_each_lot_and_block(keys):
    rows = exact_dedup.lot_planes(keys).collect()
    blocks = WORDS // exact_dedup.BLOCK_WORDS
    assert len(rows) <= LOTS * blocks < ROWS / 20
    assert sum(len(r.once) + len(r.twice) for r in rows) <= 2 * (ROWS * 2 // 3 + 1) + 4 * LOTS + ROWS // 100
    assert exact_dedup.lot_planes(keys).schema["once"].dataType.simpleString() == "array<smallint>"


def test_the_filter_has_the_bits_of_two_rows_or_more(keys):
    seen = Counter((r.word, b) for r in keys.collect() for b in {r.bit_a, r.bit_b})
    want = defaultdict(int)
    for (word, bit), n in seen.items():
        if n > 1:
            want[word] |= 1 << bit
    packed = {r.block * exact_dedup.PACKED + k: w % 2**64 for r in exact_dedup.repeated_filter(keys).collect() for k, w in enumerate(r.packed) if w}
    assert packed == want


def test_a_lot_is_folded_without_an_exchange(spark, keys):
    table = exact_dedup.written_in_lots(keys.drop("lot"))
    plan = exact_dedup.lot_planes(table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
