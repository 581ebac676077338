"""Copy barriers and insertion runs of hits as windows over a table, without a group's hits in one row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociweave.storage import input_width, together


def with_barriers(hits: DataFrame, keys: list[str], number: str, start: str, end: str, beside: list[str] | None = None) -> DataFrame:
    """hits with later_end and earlier_start of each: where the nearest further copy of its number ends, and where the nearest one before starts.

    start and end are along the strand; copies must lie wholly behind a hit or before it, those that only touch count.  A copy is a hit of the same
    keys (nulls are equal) and number.  Null where there is none.

    Two sweeps: every hit is there as a copy, at its start with its end, and as a question, at its end; the smallest end of all copies from a
    question's place on is its answer.  The other way round for what lies before.  Hits are dealt once, by keys and number, or by the columns
    `beside`, some of keys, where rows of these are to meet in the end.
    """
    by = [*keys, number]

    def swept(df: DataFrame, copy_at: str, copy_value: str, ask_at: str, answer, ahead: bool, name: str) -> DataFrame:
        both = df.withColumn("_asks", F.explode(F.array(F.lit(False), F.lit(True))))
        both = both.withColumns({"_at": F.when(F.col("_asks"), F.col(ask_at)).otherwise(F.col(copy_at)), "_value": F.when(~F.col("_asks"), F.col(copy_value))})
        order = Window.partitionBy(*by).orderBy("_at")
        frame = order.rangeBetween(0, Window.unboundedFollowing) if ahead else order.rangeBetween(Window.unboundedPreceding, 0)
        return both.withColumn(name, answer("_value").over(frame)).where("_asks").drop("_asks", "_at", "_value")

    rows = swept(together(hits, input_width(hits), beside or by), start, end, end, F.min, True, "later_end")
    return swept(rows, end, start, start, F.max, False, "earlier_start")


def may_follow(one, other):
    """Whether hit `other` may follow hit `one` in a chain: both are (number, start, end, later_end, earlier_start) columns of with_barriers.

    Numbers rise, places do not overlap, and no further copy of either number lies wholly between.
    """
    (n, _, e, later, _), (m, s, _, _, earlier) = one, other
    open_ = (later.isNull() | (later > s)) & (earlier.isNull() | (earlier < e))
    return (n < m) & (e <= s) & open_


def insertion_run_sets(hits: DataFrame, keys: list[str], order: list[str], inserted: str, number: str) -> DataFrame:
    """keys, run, numbers, first: one row a run of inserted hits in a row, in the given order, with its distinct exon numbers, sorted.

    run counts from 1 in the order of the runs; first is the place (a struct of `order`) of the run's first hit.
    """
    place = Window.partitionBy(*keys).orderBy(*order)
    fresh = F.col(inserted) & ~F.coalesce(F.lag(inserted).over(place), F.lit(False))
    marked = hits.withColumn("_fresh", fresh.cast("int"))
    numbered = marked.withColumn("run", F.sum("_fresh").over(place.rowsBetween(Window.unboundedPreceding, 0))).where(inserted)
    return numbered.groupBy(*keys, "run").agg(F.array_sort(F.collect_set(number)).alias("numbers"), F.min(F.struct(*order)).alias("first"))
