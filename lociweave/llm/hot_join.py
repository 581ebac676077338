"""Joins of many rows with one row a key, where a few keys may hold a large part of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that hold at least one in SHARE of all rows are hot: there are SHARE of them at most, so that they can be broadcast.
SHARE = 1024


def join_counted(rows: DataFrame, kinds: DataFrame, keys: list[str], n: str = "_n") -> DataFrame:
    """Each of rows with the row of kinds of its keys; rows without one are left out, a null key being a key.

    kinds holds a row a key and, in `n`, of how many rows that key is.  Hot kinds (n * SHARE is at least the sum of n, so SHARE rows at
    most) are broadcast and their rows stay where they are; the others are shuffled, where no key holds more than one in SHARE rows.
    Pass a written table as kinds: it is read for the sum and for each of the two joins.
    """
    total = kinds.agg(F.sum(n)).first()[0] or 0
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    others = [c for c in kinds.columns if c not in keys and c != n]
    hot = F.col(n) * SHARE >= total
    same = lambda a: reduce(lambda x, y: x & y, [a[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    few = F.broadcast(kinds.where(hot).select(*named, *others, F.lit(True).alias("_hot")))
    met = rows.join(few, same(rows), "left")
    done = met.where("_hot").select(*rows.columns, *others)
    rest = met.where("_hot IS NULL").select(*rows.columns)
    return done.unionByName(rest.join(kinds.where(~hot).select(*named, *others), same(rest)).select(*rows.columns, *others))
