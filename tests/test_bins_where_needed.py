"""Bins are for keys of many rows; with and without them results are the same, and what is costly is made once."""

import random

from pyspark.sql import functions as F

from conftest import SF
from lociweave import queries
from lociweave.operators import intervals, low_complexity
from lociweave.operators.barriers import with_barriers
from lociweave.plans.evidence import with_blocks
from lociweave.plans.resolution import with_rank


def test_masked_runs_are_made_once_and_read_together(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(k, "".join(rng.choice(("ACGT", "AC", "ACGTN")[k % 3]) for _ in range(rng.choice((0, 3, 5, 20, 63, 64, 65, 300, 20_000))))) for k in range(60)]
    frame = spark.createDataFrame(rows, "id int, s string").coalesce(2)
    found = low_complexity.masked_runs(frame, "id", "s", 64, 1.2)
    assert "MapInArrow" not in found._jdf.queryExecution().toString()
    want = sorted(map(tuple, found.collect()))
    assert len({k for k, *_ in want}) > 5
    monkeypatch.setattr(low_complexity, "TOGETHER", 0)
    monkeypatch.setattr(intervals, "KEY_ROWS", 0)
    assert sorted(map(tuple, low_complexity.masked_runs(frame, "id", "s", 64, 1.2).collect())) == want


def test_bins_are_for_large_keys(spark, monkeypatch):
    table = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "k int, v int")
    assert intervals.bins_for(table, ["k"], 10) is None and intervals.bins_for(table, ["k"], None) is None
    monkeypatch.setattr(intervals, "KEY_ROWS", 1)
    assert intervals.bins_for(table, ["k"], 10) == 10
    assert intervals.bins_for(table.where("v > 5"), ["k"], 10) is None


def plan_of(frame):
    return frame._jdf.queryExecution().toString()


def rows(frame, columns):
    return sorted(map(tuple, frame.select(*columns).collect()))


def test_chain_links_deal_their_hits_once(spark):
    plan = plan_of(queries.queries()["chain_links"](spark, SF)).split("== Physical Plan ==")[1]
    assert "Exchange hashpartitioning(query_id" in plan and "walls" not in plan
    # null numbers are copies of each other, and ones dealt by fewer columns have the same walls
    hits = spark.createDataFrame([(1, n, s, s + 5) for n in (1, 2, None) for s in (0, 3, 8, 20, 40)], "k int, n int, s int, e int")
    one, other = (with_barriers(hits, ["k"], "n", "s", "e", **more) for more in ({}, {"beside": ["k"]}))
    text = lambda frame: sorted(map(str, frame.collect()))
    assert text(one) == text(other) and one.where("n IS NULL AND s = 8").select("later_end", "earlier_start").first() == (25, 3)


def test_blocks_need_no_join_where_keys_are_small(spark, monkeypatch):
    rng = random.Random(9)
    hits = spark.createDataFrame([(q, st, s, s + rng.choice((0, 0, 4, 30)), k) for k in range(900) for q in (1, 2) for st in "+-" for s in [rng.randint(0, 4000)]], "query_id int, strand string, qs int, qe int, k int")
    columns = ["query_id", "strand", "qs", "qe", "k", "block_start", "block_end"]
    small = with_blocks(hits, "qs", "qe", bin_size=500)
    assert "Join" not in plan_of(small)
    assert rows(small, [*columns, "block_id"]) == rows(with_blocks(hits, "qs", "qe"), [*columns, "block_id"])
    monkeypatch.setattr(intervals, "KEY_ROWS", 0)
    binned = with_blocks(hits, "qs", "qe", bin_size=500)
    assert "Join" in plan_of(binned) and rows(binned.where("qe > qs"), columns) == rows(small.where("qe > qs"), columns)


def test_ranks_need_no_join_where_keys_are_small(spark, monkeypatch):
    rng = random.Random(10)
    calls = spark.createDataFrame([(k, k % 3, float(rng.randint(1, 4000)) * (1 + rng.choice((0, 1e-14)))) for k in range(600)], "id int, q int, score double")
    small = with_rank(calls, ["q"], F.lit(False), "score")
    assert "Join" not in plan_of(small)
    want = rows(small, ["id", "_rank._level"])
    monkeypatch.setattr(intervals, "KEY_ROWS", 0)
    assert rows(with_rank(calls, ["q"], F.lit(False), "score"), ["id", "_rank._level"]) == want


def test_report_of_full_genes_makes_blocks_of_rows(spark):
    plan = queries.queries()["full_gene_report"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # one aggregate of lists (in part and in whole), not one of single exons before it
    assert plan.count("ObjectHashAggregate") == 2
