"""Interval operators over half-open [start, end) columns: islands, range joins, covered length."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociweave.storage import dealt, input_width


def overlap_length(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start))


#: Rows of a key that one task windows where bins may be had.
KEY_ROWS = 1 << 19


def bins_for(table: DataFrame, keys: list[str], bin_size: float | None) -> float | None:
    """bin_size if a key of the table has more than KEY_ROWS rows, else None: small keys need no bins, whose rows meet by joins.

    Table is counted at once, so it should be one that has been written.
    """
    if bin_size is None:
        return None
    most = table.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return bin_size if most and most > KEY_ROWS else None


def _fresh(before: Column, start: str, touching: bool) -> Column:
    apart = F.col(start) > before if touching else F.col(start) >= before
    return F.when(before.isNull() | apart, 1).otherwise(0).cast("long")


def with_starts(df: DataFrame, keys: list[str], start: str, end: str, touching: bool = False, placed: bool = False) -> DataFrame:
    """df with `_new`, 1 on the row that begins an island of its key, else 0; placed: rows of a key are in one partition already and stay there."""
    rows = df.where(F.col(start).isNotNull() & F.col(end).isNotNull())
    before = Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    return (rows if placed else dealt(rows, input_width(df), keys)).withColumn("_new", _fresh(F.max(end).over(before), start, touching))


def islands(
    df: DataFrame, keys: list[str], start: str, end: str, touching: bool = False, name: str = "island", bin_size: int | None = None
) -> DataFrame:
    """Number the groups of overlapping intervals of each key 1, 2, ... by position.

    touching: intervals that only meet (end = start) are one island; else they are two.  A null key is a key; intervals
    with a null bound get no rows.  bin_size cuts long keys into position bins: rows are then windowed by (key, bin), and
    only one row a bin is windowed by key, so that a key of any size spreads over many tasks.  The larger the input's
    files, the more partitions its keys are dealt to.
    """
    if bin_size is None:
        order = Window.partitionBy(*keys).orderBy(start, end)
        flagged = with_starts(df, keys, start, end, touching)
        return flagged.withColumn(name, F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")

    fresh = lambda before: _fresh(before, start, touching)
    rows = df.where(F.col(start).isNotNull() & F.col(end).isNotNull())
    binned = rows.withColumn("_bin", F.floor(F.col(start) / bin_size))
    before_bins = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    renamed = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]

    def with_bins(left: DataFrame, agg: Column, over, column: str) -> DataFrame:
        bins = left.groupBy(*renamed, F.col("_bin").alias("_b")).agg(agg.alias("_v"))
        bins = bins.withColumn(column, over("_v")).drop("_v")
        same = [left[k].eqNullSafe(bins[f"_k{i}"]) for i, k in enumerate(keys)]
        return left.join(bins, reduce(lambda a, b: a & b, same, left["_bin"] == bins["_b"])).select(*left.columns, column)

    order = Window.partitionBy(*keys, "_bin").orderBy(start, end)
    carried = with_bins(binned, F.max(end), lambda v: F.max(v).over(before_bins), "_carry")
    last = F.greatest(F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.col("_carry"))
    flagged = carried.withColumn("_new", fresh(last))
    based = with_bins(flagged, F.sum("_new"), lambda v: F.coalesce(F.sum(v).over(before_bins), F.lit(0)), "_base")
    # the joins may have changed the order of equal intervals: the one that begins an island comes first
    again = Window.partitionBy(*keys, "_bin").orderBy(start, end, F.desc("_new"))
    inside = F.sum("_new").over(again.rowsBetween(Window.unboundedPreceding, 0))
    return based.withColumn(name, F.col("_base") + inside).drop("_bin", "_carry", "_new", "_base")


def merged(df: DataFrame, keys: list[str], start: str, end: str, touching: bool = True, bin_size: int | None = None) -> DataFrame:
    """keys, island, start, end: one row an island; empty intervals (end <= start) are dropped first."""
    real = df.where(F.col(end) > F.col(start))
    numbered = islands(real, keys, start, end, touching, "island", bin_size)
    return numbered.groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end))


def range_join(
    left: DataFrame, right: DataFrame, keys: list[str], bin_size: int, left_span: tuple[str, str], right_span: tuple[str, str], contained: bool = False
) -> DataFrame:
    """Pairs of one key whose intervals overlap (touching does not count); contained: the left lies within the right.

    Both sides go to every position bin that they touch, which makes the join an equi-join; a pair is kept in the bin of
    the later start alone.  Columns of both sides come back, keys once; other names must differ.
    """

    def binned(df: DataFrame, span: tuple[str, str], name: str) -> DataFrame:
        real = df.where(F.col(span[1]) > F.col(span[0]))
        return real.withColumn(name, F.explode(F.sequence(F.floor(F.col(span[0]) / bin_size), F.floor((F.col(span[1]) - 1) / bin_size))))

    a, b = binned(left, left_span, "_bin"), binned(right, right_span, "_bin")
    width, by = input_width(left, right), [*keys, "_bin"]
    met = dealt(a, width, by).join(dealt(b, width, by), by)
    (s, e), (u, v) = [tuple(map(F.col, x)) for x in (left_span, right_span)]
    inside = (s >= u) & (e <= v) if contained else (s < v) & (u < e)
    return met.where(inside & (F.floor(F.greatest(s, u) / bin_size) == F.col("_bin"))).drop("_bin")


def copy_counts(df: DataFrame, groups: list[str], item: str, strand: str, start: str, end: str, placed: bool = False) -> DataFrame:
    """groups, item, n: the number of copy clusters of each item that a group has rows of; placed: rows of a group are in one partition.

    A cluster is an island of one item and strand.
    """
    begun = with_starts(df, [*groups, item, strand], start, end, placed=placed)
    return begun.groupBy(*groups, item).agg(F.sum("_new").alias("n"))


def equal_copy_counts(df: DataFrame, groups: list[str], items: DataFrame, item: str, strand: str, start: str, end: str) -> DataFrame:
    """groups, balanced: whether all expected items of a group have the same positive number of copy clusters.

    Clusters are those of copy_counts; items: (groups, item) that are expected, with or without rows.
    """
    counts = copy_counts(df, groups, item, strand, start, end)
    filled = items.select(*groups, item).distinct().join(counts, [*groups, item], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return filled.groupBy(*groups).agg(((F.min("n") > 0) & (F.min("n") == F.max("n"))).alias("balanced"))
