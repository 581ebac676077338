"""Competition of calls for blocks as rounds of joins: islands of any size spread over tasks.

In a round every call that beats all calls with which it shares a block is selected, all at once; the others lose the blocks that went and are scored
anew.  As scores only fall when blocks go, a call that leads on each of its blocks cannot be overtaken, so the rounds select what going
through the calls one by one, the best first, would.  Calls that share blocks and have one rank are decided together: a tie group is
selected if all its calls lead on all their blocks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociweave.operators.graph import connected_components
from lociweave.operators.intervals import bins_for, islands
from lociweave.storage import drop, written

#: Scores are one rank if they differ by less than this share.
CLOSE = 1e-12
MOST_ROUNDS = 1000
_BLOCK = ("block_start", "block_end")


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def with_rank(calls: DataFrame, keys: list[str], first: Column, score: str, name: str = "_rank", bin_size: float | None = 1000.0) -> DataFrame:
    """calls with a rank that is one for calls of one rank of their keys, and larger for better ones: `first` before others, then by score.

    Scores as good as equal (CLOSE) are one rank.  Ranks are islands of scores, which are found in bins of bin_size where keys have many calls.
    calls are counted at once, so they should be a table that has been written.
    """
    marked = calls.withColumns({"_first": first, "_low": F.col(score), "_high": F.col(score) + CLOSE * F.abs(score)})
    of = [*keys, "_first"]
    placed = islands(marked, of, "_low", "_high", touching=True, name="_level", bin_size=bins_for(marked, of, bin_size))
    return placed.withColumn(name, F.struct("_first", "_level")).drop("_first", "_low", "_high", "_level")


def tie_components(calls: DataFrame, blocks: DataFrame, keys: list[str], call: str = "_id", rank: str = "_rank") -> DataFrame:
    """calls (call, keys, rank) with component and tie_count: calls of one rank that share blocks, directly or through others.

    blocks: (call, keys, block_start, block_end), distinct.  component is the smallest call of it; a call that shares no block with one of
    its rank is its own.  Edges lead from a block's smallest call of a rank to its others, so a block that many share costs a row a call.
    """
    at = blocks.join(calls.select(call, rank), call)
    place = [*keys, *_BLOCK, rank]
    hub = F.min(call).over(Window.partitionBy(*place))
    edges = written(at.select(F.col(call).alias("_call"), hub.alias("_hub")).where(F.col("_call") != F.col("_hub")).distinct(), "ties")
    if edges.isEmpty():
        return calls.withColumns({"component": F.col(call), "tie_count": F.lit(1).cast("long")})
    found = connected_components(edges, "_call", "_hub")
    sized = found.join(found.groupBy("component").agg(F.count("*").alias("tie_count")), "component")
    met = calls.join(sized, calls[call] == sized["node"], "left")
    return met.select(*calls.columns, F.coalesce("component", F.col(call)).alias("component"), F.coalesce("tie_count", F.lit(1).cast("long")).alias("tie_count"))


def scores_of(hits: Column, facts: dict[str, Column]) -> dict[str, Column]:
    """raw, weighted and found of a call without inserted hits; facts: expected, coding, mane, coding_x, complete_x, mane_x.

    A block counts once, with the score of its first hit; blocks are summed in their order, so that a score is the same however it is made.
    """
    block = lambda h: F.struct(*[h[c].alias(c) for c in _BLOCK])
    placed = F.array_sort(F.transform(hits, lambda h, i: F.struct(block(h).alias("b"), i.alias("i"), h["score"].alias("score"))))
    start = F.struct(F.lit(None).cast("struct<block_start: bigint, block_end: bigint>").alias("b"), F.lit(0.0).alias("raw"))
    add = lambda a, x: F.struct(x["b"].alias("b"), F.when(a["b"].eqNullSafe(x["b"]), a["raw"]).otherwise(a["raw"] + x["score"]).alias("raw"))
    raw = F.aggregate(placed, start, add, lambda a: a["raw"])
    found = F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["number"])))
    complete = (facts["expected"] > 0) & (F.size(found) >= facts["expected"])
    weighted = raw
    for flag, times in ((facts["coding"], "coding_x"), (complete, "complete_x"), (facts["mane"], "mane_x")):
        weighted = F.when(flag, weighted * facts[times]).otherwise(weighted)
    return {"raw": raw, "weighted": weighted, "found": found}


def _shape(hits: Column) -> Column:
    return F.array_sort(F.transform(hits, lambda h: F.struct(h["number"].alias("n"), h["exon_id"].alias("x"), h["start"].alias("s"), h["end"].alias("e"))))


def resolved_in_rounds(calls: DataFrame, prefer_mane: bool, keys: list[str]) -> DataFrame:
    """The selected calls (_id) with what is left of them: hits, raw, weighted, found, component and tie_count.

    calls: _id, keys, gene, tid, mane, coding, exon_length, expected, coding_x, complete_x, mane_x, weighted and hits (number, exon_id, start, end,
    block_start, block_end, score, ...), none of them inserted and no score below zero.  Among tied calls that share blocks each gene keeps
    its longest isoform, then the smallest name, then the first in place; the others go on with what they have left.  component is a name
    of the tie group that a selected call is in: the smallest _id of those selected together that share blocks.

    A round costs a few joins over the calls that are still open; there are as many as calls can wait for each other.
    """
    first = F.lit(prefer_mane) & F.col("mane")
    open_ = written(calls.where("size(hits) > 0"), "open")
    chosen = []
    for _ in range(MOST_ROUNDS):
        if open_.isEmpty():
            break
        ranked = written(with_rank(open_.drop("_rank"), keys, first, "weighted"), "ranked")
        blocks = ranked.select("_id", *keys, "_rank", F.explode(F.array_distinct(F.transform("hits", lambda h: F.struct(*[h[c].alias(c) for c in _BLOCK])))).alias("b"))
        blocks = written(blocks.select("_id", *keys, "_rank", *[F.col(f"b.{c}").alias(c) for c in _BLOCK]), "blocks")
        place = [*keys, *_BLOCK]
        top = blocks.groupBy(*place).agg(F.max("_rank").alias("_top"))
        beaten = blocks.join(top, _same(blocks, top, place)).where(F.col("_rank") < F.col("_top")).select("_id").distinct().withColumn("_beaten", F.lit(True))
        tied = tie_components(ranked.select("_id", *keys, "_rank"), blocks.drop("_rank"), keys).select("_id", "component")
        groups = ranked.join(tied, "_id").join(beaten, "_id", "left")
        waiting = groups.where("_beaten").select("component").distinct()
        leading = written(groups.join(waiting, "component", "left_anti").drop("_beaten"), "leading")
        order = Window.partitionBy("component", "gene").orderBy(F.desc("exon_length"), "tid", _shape(F.col("hits")), "_id")
        won = written(leading.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k", "component"), "won")
        gone = blocks.join(won.select("_id"), "_id", "left_semi").select(*place).distinct()
        held = written(won.select("_id", *keys, "_rank"), "held")
        named = tie_components(held, blocks.join(held.select("_id"), "_id", "left_semi").drop("_rank"), keys).select("_id", "component", "tie_count")
        chosen.append(written(won.drop("_rank").join(named, "_id"), "chosen"))
        left = ranked.join(won.select("_id"), "_id", "left_anti")
        lost = blocks.join(gone, _same(blocks, gone, place), "left_semi").groupBy("_id").agg(F.collect_set(F.struct(*_BLOCK)).alias("_lost"))
        met = left.join(lost, "_id", "left")
        rest = F.filter("hits", lambda h: ~F.array_contains("_lost", F.struct(*[h[c].alias(c) for c in _BLOCK])))
        trimmed = met.where("_lost IS NOT NULL").withColumn("hits", rest).drop("_lost").where("size(hits) > 0")
        facts = {c: F.col(c) for c in ("expected", "coding", "mane", "coding_x", "complete_x", "mane_x")}
        trimmed = trimmed.withColumns(scores_of(F.col("hits"), facts))
        after = written(met.where("_lost IS NULL").drop("_lost").unionByName(trimmed.select(*left.columns)).drop("_rank"), "open")
        for table in (open_, ranked, blocks, leading, won, held):
            drop(table)
        open_ = after
    else:
        raise RuntimeError(f"calls did not settle in {MOST_ROUNDS} rounds")
    empty = calls.where("false").withColumns({"component": F.col("_id"), "tie_count": F.lit(1).cast("long")})
    return reduce(lambda a, b: a.unionByName(b), chosen, empty.select(*calls.columns, "component", "tie_count"))
