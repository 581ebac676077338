"""Gapless row numbers without a one-task window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociweave.storage import shuffle_width, written


def gapless_index(df: DataFrame, groups: list[str], order: list[str | Column], name: str = "slot") -> DataFrame:
    """Number the rows of each group 0, 1, 2, ... in the order of `order` (nulls first; a null group is a group).

    Rows are dealt by range over (groups, order), so a group of any size spreads over as many tasks as it fills; only
    row counts of (task, group) meet, and these are summed by a window over at most tasks + groups rows.  The numbered
    rows are written once, so that a retried task cannot number them anew.  Rows equal in groups and order get
    consecutive numbers in any order.  Pass narrow rows: they are shuffled and written.  The sums, one row for each task
    and each group in it, are broadcast: groups are meant to be thousands at most, of any size each.
    """
    ranged = (
        df.repartitionByRange(shuffle_width(df.sparkSession), *groups, *order)
        .sortWithinPartitions(*groups, *order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    table = written(ranged, "gapless").withColumn("_task", F.shiftright("_at", 33))
    counts = table.groupBy(*groups, "_task").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_task").alias("_t"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    same = [table[g].eqNullSafe(base[f"_g{i}"]) for i, g in enumerate(groups)]
    joined = table.join(F.broadcast(base), reduce(lambda a, b: a & b, same, table["_task"] == base["_t"]))
    return joined.select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name))


def running_total(df: DataFrame, groups: list[str], order: list[str | Column], value: str, name: str) -> DataFrame:
    """df with `name`: the sum of `value` over the rows before each row, in the order of `order` within its group.

    Like gapless_index: rows are dealt by range, each task sums its own, and one sum a task and group is carried on.
    """
    ranged = (
        df.repartitionByRange(shuffle_width(df.sparkSession), *groups, *order)
        .sortWithinPartitions(*groups, *order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    table = written(ranged, "totals").withColumn("_task", F.shiftright("_at", 33))
    before = Window.partitionBy(*groups, "_task").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    inside = table.withColumn("_inside", F.coalesce(F.sum(value).over(before), F.lit(0)))
    sums = table.groupBy(*groups, "_task").agg(F.sum(value).alias("_sum"))
    carried = Window.partitionBy(*groups).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_task").alias("_t"), F.coalesce(F.sum("_sum").over(carried), F.lit(0)).alias("_base"))
    same = [inside[g].eqNullSafe(base[f"_g{i}"]) for i, g in enumerate(groups)]
    joined = inside.join(F.broadcast(base), reduce(lambda a, b: a & b, same, inside["_task"] == base["_t"]))
    return joined.select(*df.columns, (F.col("_inside") + F.col("_base")).alias(name))
