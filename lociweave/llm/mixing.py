"""Mixing sources to target weights by Pfair scheduling.

The rows of a source, repeated in epochs, are a stream that is cut into blocks.  With weight p / D, block j of a source is
released at slot floor(j * D / p) and due at slot ceil((j + 1) * D / p); every slot goes to the released block of the
earliest deadline.  As the weights sum to one, every deadline is met, so after any number of slots each source has had its
weight's share to within less than one block.  Weights are exact fractions, and release and deadline of a block follow
from its number, so that nothing as long as D is needed: the slots are simulated to the end of the mixture, or for D slots
where the schedule repeats before, by one task that holds two entries a source.

The mixture ends when every row has been scheduled.  A source that is due more rows than it has by then starts over
(epoch 1, 2, ...): no row is left out, and the mixture keeps its weights to the end.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice
from math import gcd, lcm

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.operators.ranking import gapless_index
from lociweave.storage import shuffle_width, written

BLOCK_ROWS = 64
MAX_SOURCES = 10_000
TEMPER = 0.9
#: A schedule of more slots than this is joined by a shuffle.
BROADCAST_SLOTS = 200_000
SLOTS = "_k int, _j long, _at long"


def integer_weights(weights: dict[str | None, float]) -> dict[str | None, int]:
    """Weights as whole parts of their sum, in their exact proportions; a float is the decimal number that it prints as."""
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("weights must be positive")
    whole = lcm(*(w.denominator for w in exact.values()))
    parts = {s: int(w * whole) for s, w in exact.items()}
    common = gcd(*parts.values())
    return {s: p // common for s, p in parts.items()}


def schedule(parts: list[int]) -> Iterator[tuple[int, int]]:
    """(source number, block number) of slot 0, 1, 2, ... without end."""
    period = sum(parts)
    waiting = [(0, k, 0) for k in range(len(parts))]  # release, source, block
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    slot = 0
    while parts:
        while waiting and waiting[0][0] <= slot:
            _, k, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // parts[k]), k, j))
        _, k, j = heapq.heappop(ready)
        yield k, j
        heapq.heappush(waiting, ((j + 1) * period // parts[k], k, j + 1))
        slot += 1


def hyperperiod(parts: dict[str | None, int]) -> list[tuple[str | None, int, int]]:
    """(source, block number, slot) over the sum(parts) slots after which the schedule repeats."""
    names = sorted(parts, key=lambda s: (s is not None, s))
    slots = islice(schedule([parts[s] for s in names]), sum(parts.values()))
    return [(names[k], j, slot) for slot, (k, j) in enumerate(slots)]


def scheduled(spark: SparkSession, parts: list[int], blocks: list[int]) -> DataFrame:
    """The schedule until each source has had its blocks, but at most the slots after which it repeats."""

    def simulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            pass
        slots, left, at = islice(schedule(parts), sum(parts)), len(blocks), 0
        while left:
            some = []
            for k, j in slots:
                some.append((k, j, at + len(some)))
                left -= j + 1 == blocks[k]
                if not left or len(some) == 1 << 16:
                    break
            if not some:
                return
            at += len(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*some, strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["_k", "_j", "_at"]
            )

    return written(spark.range(0, 1, 1, 1).mapInArrow(simulate, SLOTS), "slots")


def mix_sources(
    docs: DataFrame, weights: dict[str | None, float] | None = None, doc_id: str = "doc_id", source: str = "source",
    block_rows: int = BLOCK_ROWS, temper: float = TEMPER, whole_rows: bool = False,
) -> DataFrame:
    """doc_id, source, epoch, block, slot, position for every scheduled row; with whole_rows the row too, as `row`.

    weights: target weight of each source (a null source is a source); by default its row count to the power `temper`.
    Rows of a source stand in the order of a hash of doc_id.  position numbers the mixture without gaps: a block goes on
    with the next epoch where one ends in it, and only the last block of all is short.  So a source of fewer rows than a
    block comes more than once in its block.  Repeated rows are rows; an empty table gives no rows; a source without rows
    is ignored, one without a weight is an error, as are more than MAX_SOURCES sources (their counts and weights are what
    the driver holds and what is broadcast).
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), F.xxhash64(F.col(doc_id)).alias("_order"),
        *([F.struct("*").alias("row")] if whole_rows else []),
    )
    counts = {r["source"]: r["count"] for r in docs.groupBy(F.col(source).cast("string").alias("source")).count().limit(MAX_SOURCES + 1).collect()}
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    names = sorted(counts, key=lambda s: (s is not None, s))
    exact = integer_weights({s: weights[s] if weights else n**temper for s, n in counts.items()}) if counts else {}
    blocks = [-(-counts[s] // block_rows) for s in names]
    times = scheduled(spark, [exact[s] for s in names], blocks)
    own = {r["_k"]: r["count"] for r in times.groupBy("_k").count().collect()}
    cycle = max(1, sum(own.values()))  # slots of `times`, which repeat if the mixture is longer
    ends = spark.createDataFrame([(k, own[k], b) for k, b in enumerate(blocks)], "_k int, _own long, _blocks long")
    last = times.join(F.broadcast(ends), "_k").where("_j = (_blocks - 1) % _own")
    end = (last.agg(F.max(F.expr(f"(_blocks - 1) div _own * {cycle} + _at"))).first()[0] or 0) + 1
    rest = {r["_k"]: r["count"] for r in times.where(F.col("_at") < end % cycle).groupBy("_k").count().collect()}
    facts = [(s, k, counts[s], own[k], (end // cycle * own[k] + rest.get(k, 0)) * block_rows) for k, s in enumerate(names)]
    facts = F.broadcast(spark.createDataFrame(facts, "_s string, _k int, _rows long, _own long, _due long"))
    numbered = gapless_index(rows, ["source"], ["_order", "doc_id"], "_rank")
    met = numbered.join(facts, numbered["source"].eqNullSafe(facts["_s"])).drop("_s")
    many = met.withColumn("epoch", F.explode(F.expr("sequence(0L, (_due - 1 - _rank) div _rows)")))
    many = many.withColumn("_at_row", F.col("epoch") * F.col("_rows") + F.col("_rank")).withColumn("block", F.expr(f"_at_row div {block_rows}"))
    times = F.broadcast(times) if cycle <= BROADCAST_SLOTS else times.hint("merge")
    timed = many.withColumn("_j", F.col("block") % F.col("_own")).join(times, ["_k", "_j"])
    timed = timed.withColumn("slot", F.expr(f"(block div _own) * {cycle} + _at")).where((F.col("slot") < end - 1) | (F.col("epoch") == 0))
    position = (F.col("slot") * block_rows + F.col("_at_row") % block_rows).alias("position")
    return timed.select("doc_id", "source", F.col("epoch").cast("int").alias("epoch"), "block", "slot", position, *(["row"] if whole_rows else []))


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """The rows of docs, all columns, in the order of the mixture (over and within partitions), repeated by epoch."""
    timed = mix_sources(docs, weights, whole_rows=True)
    return timed.repartitionByRange(shuffle_width(docs.sparkSession), "position").sortWithinPartitions("position").select("row.*")
