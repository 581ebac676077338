"""Sharding: contiguous minimax partition of ordered atomic groups.

Rows of equal text form one atomic group and the groups stand in the order of a 64-bit hash of the text.  The smallest
shard capacity for which a greedy walk over the ordered group sizes needs at most `shards` shards is found by binary
search, and the shards are cut where that walk cuts.

The group sizes never meet in one place.  The ordered line of hashes is seen through a tree: a node is a hash prefix,
and its size is one sum made by Spark.  The driver holds the children of the nodes in which a cut can fall, opens those
nodes alone (all open nodes of a round in one job), and stops when every cut of the best capacity falls between two
whole groups.  That is a few thousand numbers at any size of the input.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.operators.ranking import gapless_index
from lociweave.storage import written

FANOUT_BITS = 10
ROOT_BITS = 14


class _Line:
    """What is known of the ordered group sizes: adjacent nodes (first hash, width in bits, size), bits 0: one group."""

    def __init__(self, nodes: list[tuple[int, int, int]]):
        self.replace(nodes)

    def replace(self, nodes: list[tuple[int, int, int]]) -> None:
        self.nodes = sorted(nodes)
        self.until = [0]
        for _, _, size in self.nodes:
            self.until.append(self.until[-1] + size)

    def walk(self, capacity: int, shards: int) -> tuple[bool, list[int], list[int]]:
        """(feasible, first node of every later shard, unopened nodes in which a cut falls).

        A cut inside an unopened node is taken where the capacity ends, which no real cut can surpass: a capacity that
        fails here fails in truth.
        """
        cuts, open_, at, total = [], [], 0, self.until[-1]
        for _ in range(shards - 1):
            if at + capacity >= total:
                return True, cuts, open_
            k = bisect_right(self.until, at + capacity) - 1
            if self.until[k] == at + capacity or self.nodes[k][1] == 0:
                at = self.until[k]
            else:
                open_.append(k)
                at += capacity
            cuts.append(k)
        return total - at <= capacity, cuts, open_

    def smallest(self, shards: int) -> int:
        low = max([-(-self.until[-1] // shards), *(n[2] for n in self.nodes if n[1] == 0), 0])
        high = max(self.until[-1], low)
        while low < high:
            middle = (low + high) // 2
            if self.walk(middle, shards)[0]:
                high = middle
            else:
                low = middle + 1
        return low


def minimax_cuts(groups: DataFrame, key: str, size: str, shards: int) -> list[int]:
    """First keys of shards 1, 2, ... for the smallest feasible capacity.

    groups: rows of (key, size), any number a key, keys any BIGINT (ordered as signed numbers), sizes positive.
    """
    table = groups.select(F.col(key).alias("k"), F.col(size).alias("s"))

    def opened(nodes: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """Children of the nodes (first key, bits): (first key, bits, size)."""
        out = []
        by_bits: dict[int, list[int]] = {}
        for first, bits in nodes:
            by_bits.setdefault(bits, []).append(first)
        for bits, firsts in by_bits.items():
            left = max(0, bits - (ROOT_BITS if bits == 64 else FANOUT_BITS))
            rows = table if bits == 64 else table.where(F.shiftright("k", bits).isin([f >> bits for f in firsts]))
            child = F.shiftright("k", left)
            for r in rows.groupBy(child.alias("c")).agg(F.sum("s").alias("s"), F.min("k").alias("a"), F.max("k").alias("b")).collect():
                out.append((int(r.a), 0, int(r.s)) if r.a == r.b else (int(r.c) << left, left, int(r.s)))
        return out

    line = _Line(opened([(0, 64)]))
    if not line.nodes:
        return []
    while True:
        capacity = line.smallest(shards)
        _, cuts, pending = line.walk(capacity, shards)
        heavy = [k for k, n in enumerate(line.nodes) if n[1] and n[2] > capacity]
        pending = sorted({*pending, *heavy})
        if not pending:
            return [line.nodes[k][0] for k in cuts]
        gone = set(pending)
        line.replace([n for k, n in enumerate(line.nodes) if k not in gone] + opened([line.nodes[k][:2] for k in pending]))


def _shard_of(key: Column, cuts: list[int]) -> Column:
    """Number of cuts at or below the key."""
    return sum((F.when(key >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")


def shard_documents(docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Give every row a shard under the law `bytes`, and a gapless slot inside it.

    Returns doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, law, shard, slot, grown_shard (null).
    The largest shard is as small as it can be while shards are runs of whole groups in hash order; with fewer groups
    than shards, or one group larger than the rest together, some shards stay empty.
    A null text counts as empty (one group with the empty texts); repeated rows are rows; a null doc_id stands first in
    its group; an empty table gives no rows.  Other columns of docs are ignored, whatever their names.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    narrow = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(body) + 8).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.xxhash64(body).alias("key"),
        ),
        "sizes",
    )
    sizes = narrow.groupBy("key").agg(F.sum("size").alias("size"))
    cuts = minimax_cuts(written(sizes, "groups"), "key", "size", shards)
    placed = narrow.withColumn("shard", _shard_of(F.col("key"), cuts))
    return gapless_index(placed, ["shard"], ["key", "doc_id"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def shard_texts(docs: DataFrame, out: str, shards: int = 24, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write docs as Parquet under out/shard=N/, every row in the shard that shard_documents gives its text."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    sizes = docs.select(F.xxhash64(body).alias("key"), (F.octet_length(body) + 8).cast("long").alias("size"))
    cuts = minimax_cuts(written(sizes.groupBy("key").agg(F.sum("size").alias("size")), "groups"), "key", "size", shards)
    docs.withColumn("shard", _shard_of(F.xxhash64(body), cuts)).write.partitionBy("shard").parquet(out)
