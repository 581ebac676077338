"""From exon alignments to hits, target blocks and one score for each block and gene."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociweave.functions.scalars import exon_score
from lociweave.operators.intervals import bins_for, islands, overlap_length
from lociweave.storage import dealt, input_width, written


def select_alignments(rows: DataFrame, least_score: float = 50.0, least_identity: float = 95.0, least_coverage: float = 90.0) -> DataFrame:
    """rows with `rejected`: the first rule that fails (AS, identity, coverage), null for alignments that stay."""
    reason = (
        F.when(~(F.col("AS") > least_score), "AS").when(~(F.col("percent_identity") > least_identity), "identity")
        .when(~(F.col("exon_coverage") >= least_coverage), "coverage")
    )
    return rows.withColumn("rejected", reason)


def known_exons(alignments: DataFrame, exons: DataFrame, key: str = "exon_id") -> DataFrame:
    return alignments.join(exons.select(key).distinct(), key, "left_semi")


def non_overlapping(rows: DataFrame, keys: list[str], start: str, end: str, better: list[Column]) -> DataFrame:
    """Per key, go through the rows best first and keep each that overlaps none kept so far (touching is allowed).

    Rows that overlap nothing of their key stay without leaving the plan; the greedy walk sees one island of overlapping
    rows at a time, since rows of different islands cannot meet.
    """
    ordered = islands(rows, keys, start, end, name="_island")
    counted = ordered.groupBy(*keys, "_island").agg(F.sort_array(F.collect_list(F.struct(
        *[b.alias(f"_b{i}") for i, b in enumerate(better)], F.col(start).alias("_s"), F.col(end).alias("_e"), F.struct(*rows.columns).alias("_row")
    ))).alias("_all"))
    kept = F.aggregate(
        "_all",
        F.slice("_all", 1, 0),
        lambda a, x: F.when(F.exists(a, lambda y: (y["_s"] < x["_e"]) & (x["_s"] < y["_e"])), a).otherwise(F.concat(a, F.array(x))),
    )
    return counted.select(F.explode(kept).alias("_x")).select("_x._row.*")


def expected_exons(assoc: DataFrame, eligible: DataFrame | None = None, region: tuple[str, int, int] | None = None) -> DataFrame:
    """(tid, numbers): sorted distinct exon numbers of eligible exons that lie in the region, if one is given."""
    rows = assoc if eligible is None else assoc.join(eligible.select("exon_id").distinct(), "exon_id", "left_semi")
    if region:
        chrom, low, high = region
        rows = rows.where((F.col("chrom") == chrom) & (overlap_length(F.col("start0"), F.col("end0"), F.lit(low), F.lit(high)) > 0))
    return rows.groupBy("tid").agg(F.array_sort(F.collect_set("exon_number")).alias("numbers"))


def hits_of(alignments: DataFrame, assoc: DataFrame, expected: DataFrame) -> DataFrame:
    """One row for each alignment and transcript exon of an expected number."""
    wanted = expected.select("tid", F.explode("numbers").alias("exon_number"))
    return alignments.join(assoc.join(wanted, ["tid", "exon_number"], "left_semi"), "exon_id")


def with_blocks(hits: DataFrame, start: str, end: str, keys: tuple[str, ...] = ("query_id", "strand"), bin_size: int | None = None) -> DataFrame:
    """Hits with block_id, block_start, block_end: islands over all genes of one query and strand (touching keeps apart).

    Hits are dealt by their keys once, and blocks are found beside them; hits without a key or a bound get no rows.  Where bin_size is given
    hits are written and counted first, and keys of many hits (intervals.KEY_ROWS) are cut into bins.
    """
    if bin_size is not None:
        hits = written(hits, "unplaced")
    if bins_for(hits, list(keys), bin_size) is None:
        held = hits.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, start, end)]))
        order = Window.partitionBy(*keys).orderBy(start, end)
        last = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
        again = (F.lag(start).over(order) == F.col(start)) & (F.lag(end).over(order) == F.col(end))
        fresh = F.when(again, 0).when(last.isNull() | (F.col(start) >= last), 1).otherwise(0).cast("long")
        numbered = dealt(held, input_width(hits), list(keys)).withColumn("_new", fresh)
        numbered = numbered.withColumn("block_id", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
        block = Window.partitionBy(*keys, "block_id")
        return numbered.withColumns({"block_start": F.min(start).over(block), "block_end": F.max(end).over(block)})
    places = hits.select(*keys, start, end).distinct()
    blocks = islands(places, list(keys), start, end, name="block_id", bin_size=bin_size)
    hull = blocks.groupBy(*keys, "block_id").agg(F.min(start).alias("block_start"), F.max(end).alias("block_end"))
    return hits.join(blocks.join(hull, [*keys, "block_id"]), [*keys, start, end])


def block_scores(hits: DataFrame, gene: str, length: str, identical: str, tiebreak: list[str], keys: tuple[str, ...] = ("query_id", "strand")) -> DataFrame:
    """(keys, block_id, gene, score, supplier...): the longest exon of a gene in a block gives the block's score.

    Ties: the higher score, then the columns of `tiebreak`.
    """
    score = exon_score(F.col(length), F.col(identical))
    best = F.min(F.struct((-F.col(length)).alias("_l"), (-score).alias("_s"), *tiebreak)).alias("best")
    rows = hits.groupBy(*keys, "block_id", gene).agg(best)
    return rows.select(*keys, "block_id", gene, (-F.col("best._s")).alias("score"), (-F.col("best._l")).alias("supplier_length"), *[F.col(f"best.{t}").alias(f"supplier_{t}") for t in tiebreak])


def with_block_scores(hits: DataFrame, gene: str, length: str, identical: str, tiebreak: list[str], keys: tuple[str, ...] = ("query_id", "strand")) -> DataFrame:
    """hits with score, supplier_length and supplier_... of their block and gene, as block_scores has them; hits without a gene get no rows.

    Hits that lie together by their keys, as with_blocks leaves them, are not dealt again.
    """
    score = exon_score(F.col(length), F.col(identical))
    best = F.min(F.struct((-F.col(length)).alias("_l"), (-score).alias("_s"), *tiebreak)).over(Window.partitionBy(*keys, "block_id", gene))
    made = hits.where(F.col(gene).isNotNull()).withColumn("_best", best)
    return made.withColumns({"score": -F.col("_best._s"), "supplier_length": -F.col("_best._l")} | {f"supplier_{t}": F.col(f"_best.{t}") for t in tiebreak}).drop("_best")
