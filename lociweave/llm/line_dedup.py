"""Line dedup: sharded cuckoo filters backed by exact reference-count tables.

The exact table has one posting for each (line key, document); adding a document appends postings of sign +1 and
deleting it appends the same postings with -1, so the count of documents that hold a key, and the largest of them, can
always be had back.  Each shard (a slice of the key space) also has a cuckoo filter of the keys held by at least
`min_docs` documents.  A line is looked up in the filter of its shard first; only lines that the filter may hold go on to
the exact table, which decides.  A change of documents inserts keys that reach the threshold into the filters and
deletes those that fall below it.  A filter that is full is built anew, with twice the buckets, from the exact table; so
are all, over more shards, once a state holds more than twice SHARD_LINES lines a shard.

Keys are 128-bit blake2b digests; a key of at least `min_chars` code points counts.  There are more shards the more lines there
are, and the lines of a shard are salted by document over as many groups as keep each group to a fair share of all lines
and to about GROUP_LINES, whatever one key holds.  Reference counts are combined before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.llm.kernels import WHITE, LineKeys, mix, slices
from lociweave.storage import shared_path, written

SHARDS, MOST_SHARDS, SHARD_LINES = 64, 1 << 16, 1 << 21
#: A shard is cut into groups of at most GROUP_LINES lines, and of one GROUPS-th of an even shard.
GROUPS, GROUP_LINES = 4, 1 << 19
LINES = "doc_id long, text_hash long, line int, h1 long, h2 long"


class CuckooFilter:
    """16-bit fingerprints, four to a bucket, two buckets a key; add, remove, and a vectorised test.

    A key is its hash h1.  A full table is doubled by the caller, who has the exact keys.
    """

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, 4), np.uint16) if table is None else table

    @classmethod
    def of(cls, hashes: np.ndarray, least_buckets: int = 4) -> CuckooFilter:
        buckets = max(least_buckets, 1 << max(2, int(len(hashes) // 3).bit_length()))
        while True:
            made = cls(buckets)
            if all(made.add(int(f), int(a)) for f, a in zip(*made.places(hashes)[:2], strict=True)):
                return made
            buckets *= 2

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and both buckets."""
        h = hashes.astype(np.uint64)
        prints = (h >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = mix(h) & np.uint64(self.buckets - 1)
        return prints, first, first ^ self._step(prints)

    def _step(self, prints: np.ndarray) -> np.ndarray:
        return mix(prints.astype(np.uint64) + np.uint64(0x51ED2701)) & np.uint64(self.buckets - 1)

    def add(self, print_: int, bucket: int) -> bool:
        step = int(self._step(np.array([print_], np.uint16))[0])
        for kick in range(500):
            for at in (bucket, bucket ^ step):
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = print_
                    return True
            bucket ^= step
            slot = kick % 4
            print_, self.table[bucket, slot] = int(self.table[bucket, slot]), print_
            step = int(self._step(np.array([print_], np.uint16))[0])
            bucket ^= step
        return False

    def remove(self, print_: int, a: int, b: int) -> None:
        for at in (a, b):
            held = np.flatnonzero(self.table[at] == print_)
            if len(held):
                self.table[at, held[0]] = 0
                return
        raise ValueError("the filter never held this key")

    def test(self, hashes: np.ndarray) -> np.ndarray:
        prints, a, b = self.places(hashes)
        wanted = prints[:, None]
        return ((self.table[a.astype(np.int64)] == wanted) | (self.table[b.astype(np.int64)] == wanted)).any(axis=1)


def line_keys(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(doc_id, text_hash, line, h1, h2) of every line whose key has at least min_chars code points."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("text_hash"), body.alias("text"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(1)
            for first, _, data, offsets in slices(batch.column(2)):
                row, line, h1, h2 = LineKeys(data, offsets, WHITE).long_lines(min_chars)
                take = pa.array(row + first)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), hashes.take(take), pa.array(line.astype(np.int32)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))],
                    names=["doc_id", "text_hash", "line", "h1", "h2"],
                )

    return rows.mapInArrow(keys, LINES)


def _shard(shards: int):
    return F.pmod(F.col("h2"), F.lit(shards)).cast("int").alias("shard")


def reference_counts(postings: DataFrame) -> DataFrame:
    """(h1, h2, n_docs, last_doc): documents that hold each key, and the largest of them."""
    held = postings.groupBy("h1", "h2", "doc_id").agg(F.sum("sign").alias("times")).where("times > 0")
    return held.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))


class LineDedup:
    """Incremental state over documents; every change gives a new state and leaves the old one usable."""

    def __init__(self, spark: SparkSession, min_docs: int = 3, min_chars: int = 20, shards: int = SHARDS):
        self.spark, self.min_docs, self.min_chars, self.shards = spark, min_docs, min_chars, min(shards, MOST_SHARDS)
        self.batches: list[str] = []
        self.held = 0  # postings added less those deleted
        self.filters = spark.createDataFrame([], "shard int, buckets int, cells binary")

    def postings(self) -> DataFrame:
        schema = "h1 long, h2 long, doc_id long, text_hash long, sign long"
        if not self.batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*self.batches)

    def changed(self, lines: DataFrame, sign: int) -> LineDedup:
        """The state after adding (sign 1) or deleting (sign -1) the rows of these line keys.

        A posting is how often a key is in the rows of one document and text.  A row has a key as often as any other row of its text, so
        taking away what was asked, but no more than is held, takes away rows that are there and leaves out those that are not.
        """
        path = shared_path(self.spark, "postings")
        place = ["h1", "h2", "doc_id", "text_hash"]
        asked = lines.groupBy(*place).agg(F.count("*").alias("times"))
        if sign > 0:
            made = asked.select(*place, F.col("times").alias("sign"))
        else:
            held = self.postings().join(asked.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").groupBy(*place).agg(F.sum("sign").alias("held")).where("held > 0")
            same = (asked["h1"] == held["h1"]) & (asked["h2"] == held["h2"]) & asked["doc_id"].eqNullSafe(held["doc_id"]) & (asked["text_hash"] == held["text_hash"])
            made = held.join(asked, same).select(*[held[c] for c in place], (-F.least("times", "held")).alias("sign"))
        made.write.parquet(path)
        after = LineDedup(self.spark, self.min_docs, self.min_chars, self.shards)
        after.batches = [*self.batches, path]
        after.held = self.held + sign * self.spark.read.parquet(path).count()
        if after.held > 2 * self.shards * SHARD_LINES and self.shards < MOST_SHARDS:
            after.shards = min(MOST_SHARDS, after.held // SHARD_LINES)
            after.filters = written(after.built(), "filters")
            return after
        over = F.col("n_docs") >= self.min_docs
        new = reference_counts(after.postings())
        if self.batches:
            touched = self.spark.read.parquet(path).select("h1", "h2").distinct()
            was = reference_counts(self.postings().join(touched, ["h1", "h2"], "left_semi")).where(over)
            now = reference_counts(after.postings().join(touched, ["h1", "h2"], "left_semi")).where(over)
            came = now.join(was, ["h1", "h2"], "left_anti").select(_shard(self.shards), "h1", F.lit(1).alias("step"))
            went = was.join(now, ["h1", "h2"], "left_anti").select(_shard(self.shards), "h1", F.lit(-1).alias("step"))
            steps = came.unionByName(went)
        else:
            steps = new.where(over).select(_shard(self.shards), "h1", F.lit(1).alias("step"))
        after.filters = written(
            self.filters.groupBy("shard").cogroup(steps.groupBy("shard")).applyInPandas(_refilter, self.filters.schema), "filters"
        )
        full = after.filters.where("cells IS NULL").select("shard", F.col("buckets").alias("least"))
        if not full.isEmpty():
            after.filters = written(after.filters.where("cells IS NOT NULL").unionByName(after.built(full)), "filters")
        return after

    def built(self, full: DataFrame | None = None) -> DataFrame:
        """Filters made of the exact table: of the shards of full (shard, least buckets), or of all."""
        postings = self.postings().select("*", _shard(self.shards))
        if full is not None:
            postings = postings.join(F.broadcast(full), "shard", "left_semi")
        keys = reference_counts(postings).where(F.col("n_docs") >= self.min_docs).select(_shard(self.shards), "h1")
        keys = keys.withColumn("least", F.lit(4)) if full is None else keys.join(F.broadcast(full), "shard")
        return keys.groupBy("shard").applyInPandas(_build, self.filters.schema)

    def add(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineDedup:
        return self.changed(line_keys(docs, doc_id, text, self.min_chars), 1)

    def delete(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineDedup:
        """Take rows out that were added with this doc_id and this very text; a row that is not held, or no more, is ignored.

        So a repeated delete changes nothing, and a row that was added twice goes once a delete.
        """
        return self.changed(line_keys(docs, doc_id, text, self.min_chars), -1)

    def dropped(self, lines: DataFrame) -> DataFrame:
        """Rows of `lines` that this state drops: keys in min_docs documents, but for the largest document's."""
        counted = lines.select(_shard(self.shards)).groupBy("shard").agg(F.count("*").alias("n"))
        fair = max(1, min(GROUP_LINES, lines.count() // (GROUPS * self.shards)))
        # one row a shard, MOST_SHARDS at most
        salts = F.broadcast(written(counted.select("shard", F.ceil(F.col("n") / fair).alias("salts")), "salts"))
        salted = lines.select("*", _shard(self.shards)).join(salts, "shard")
        salted = salted.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash", "line"), "salts"))
        filters = self.filters.join(salts, "shard").select(
            "shard", "buckets", "cells", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")
        )
        maybe = salted.drop("salts").groupBy("shard", "salt").cogroup(filters.groupBy("shard", "salt")).applyInPandas(_probe, LINES)
        # written, so that the join below has two plain exchanges and Spark can split the lines of a hot key
        exact = written(reference_counts(self.postings()).where(F.col("n_docs") >= self.min_docs), "counts")
        return maybe.join(exact, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("last_doc"))).select(lines.columns)


def _refilter(old: pd.DataFrame, steps: pd.DataFrame) -> pd.DataFrame:
    """The filter of one shard after its keys came (step 1) and went (step -1); if full, null cells and twice the buckets."""
    shard = int((old if len(old) else steps)["shard"].iloc[0])
    came = steps.loc[steps["step"] == 1, "h1"].to_numpy().view(np.uint64)
    if not len(old):
        made = CuckooFilter.of(came)
    else:
        buckets = int(old["buckets"].iloc[0])
        made = CuckooFilter(buckets, np.frombuffer(old["cells"].iloc[0], np.uint16).reshape(buckets, 4).copy())
        for f, a, b in zip(*made.places(steps.loc[steps["step"] == -1, "h1"].to_numpy().view(np.uint64)), strict=True):
            made.remove(int(f), int(a), int(b))
        for f, a in zip(*made.places(came)[:2], strict=True):
            if not made.add(int(f), int(a)):
                return pd.DataFrame({"shard": [shard], "buckets": [2 * buckets], "cells": [None]})
    return pd.DataFrame({"shard": [shard], "buckets": [made.buckets], "cells": [made.table.tobytes()]})


def _build(keys: pd.DataFrame) -> pd.DataFrame:
    made = CuckooFilter.of(keys["h1"].to_numpy().view(np.uint64), int(keys["least"].iloc[0]))
    return pd.DataFrame({"shard": [int(keys["shard"].iloc[0])], "buckets": [made.buckets], "cells": [made.table.tobytes()]})


def _probe(lines: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    columns = ["doc_id", "text_hash", "line", "h1", "h2"]
    if not len(lines) or not len(filters):
        return lines[columns].iloc[:0]
    buckets = int(filters["buckets"].iloc[0])
    held = CuckooFilter(buckets, np.frombuffer(filters["cells"].iloc[0], np.uint16).reshape(buckets, 4))
    return lines.loc[held.test(lines["h1"].to_numpy().view(np.uint64)), columns]


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """Every row of docs with `text` cut to the lines that stay, and n_lines, n_dropped; other columns are dropped.

    A line's key is the line without white space at its ends, A-Z lower-cased.  Null and empty texts are one empty line.
    Rows of one doc_id are one document when documents are counted (a null doc_id too, below all others), and each row's
    own text is cut.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    lines = written(line_keys(docs, doc_id, text, min_chars), "lines")
    state = LineDedup(spark, min_docs, min_chars, max(SHARDS, lines.count() // SHARD_LINES)).changed(lines, 1)
    drops = state.dropped(lines).groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).agg(F.collect_set("line").alias("_drop"))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("_text_hash"))
    met = rows.join(drops, (rows["_text_hash"] == drops["_h"]) & rows["doc_id"].eqNullSafe(drops["_d"]), "left")
    split = met.withColumn("_lines", F.split("text", "\n"))
    stay = F.expr("transform(array_except(sequence(0, size(_lines) - 1), _drop), i -> _lines[i])")
    return split.select(
        "doc_id",
        F.when(F.col("_drop").isNull(), F.col("text")).otherwise(F.array_join(stay, "\n")).alias("text"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )
