"""Approximate search by seeds: minimisers that query and target share, chained along diagonals into candidate places."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from lociweave.operators.bit_filter import code_bits
from lociweave.operators.intervals import islands
from lociweave.operators.minimisers import minimisers
from lociweave.storage import written

#: Positions of one query, target and strand that one task looks at when gaps are found.
BIN = 1_000_000


def store_index(targets: DataFrame, target_id: str, seq: str, table: str, k: int = 19, w: int = 5, masked: bool = False, buckets: int = 64) -> None:
    """Write the minimisers of targets as a table of the catalogue, bucketed and sorted by code, for many searches (seeds_of_index)."""
    minimisers(targets, target_id, seq, k, w, masked).write.bucketBy(buckets, "code").sortBy("code").mode("overwrite").saveAsTable(table)


def seeds_of_index(queries: DataFrame, query_id: str, seq: str, index: DataFrame, target_id: str, k: int = 19, w: int = 5, most: int = 1000, masked: bool = False) -> tuple[DataFrame, DataFrame]:
    """(seeds, repeats) as minimiser_seeds gives them, against a stored index (spark.table) of the same k, w and masking.

    The index is neither read through a filter nor shuffled: counting its codes and meeting the queries' both go by its buckets, so a
    search costs a shuffle of the queries' minimisers.
    """
    return _met(minimisers(queries, query_id, seq, k, w, masked), query_id, index, target_id, most)


def _met(asked: DataFrame, query_id: str, found: DataFrame, target_id: str, most: int) -> tuple[DataFrame, DataFrame]:
    asked = written(asked, "asked")
    counted = found.join(asked.select("code").distinct(), "code", "left_semi").groupBy("code").agg(F.count("*").alias("n"))
    repeats = written(counted.where(F.col("n") > most), "repeats")
    one = asked.join(repeats, "code", "left_anti").select("code", query_id, F.col("length").alias("query_length"), F.col("at").alias("query_at"), F.col("reverse").alias("_q"))
    other = found.select("code", target_id, F.col("length").alias("target_length"), F.col("at").alias("target_at"), F.col("reverse").alias("_t"))
    met = other.join(one, "code")
    return met.select(query_id, "query_length", "query_at", target_id, "target_length", "target_at", (F.col("_q") != F.col("_t")).alias("reverse")), repeats


def minimiser_seeds(
    queries: DataFrame, query_id: str, targets: DataFrame, target_id: str, seq: str, k: int = 19, w: int = 5, most: int = 1000, masked: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(seeds, repeats) of sequences in queries (query_id, seq) and targets (target_id, seq).

    seeds: query_id, query_length, query_at, target_id, target_length, target_at, reverse; one row for each pair of places that have
    one minimiser, reverse where they have it on opposite strands.  Minimisers that the targets have more than `most` times seed
    nothing; repeats (code, n) lists them, as far as queries have them.  So a code makes at most `most` pairs a query place.

    Targets are read once, where they stand, through a filter of the queries' codes.
    """
    asked = written(minimisers(queries, query_id, seq, k, w, masked), "asked")
    found = written(minimisers(targets, target_id, seq, k, w, masked, code_bits(asked.select("code").distinct())), "found")
    return _met(asked, query_id, found, target_id, most)


def seeds_in_windows(queries: DataFrame, query_genes: DataFrame, windows: DataFrame, k: int = 11, w: int = 3) -> DataFrame:
    """Seeds (as minimiser_seeds) of each gene's queries in the windows of that gene alone, for words that are too short to seed a genome.

    queries: (query_id, sequence), unique; query_genes: (query_id, gene); windows: (gene, contig, contig_length, window_start, sequence).  Where
    windows of several genes overlap, a pair of places is one row.
    """
    asked = minimisers(queries, "query_id", "sequence", k, w).join(query_genes.select("query_id", "gene").distinct(), "query_id")
    named = written(windows.select(F.monotonically_increasing_id().alias("window"), "gene", "contig", "contig_length", "window_start", "sequence"), "windows")
    found = minimisers(named, "window", "sequence", k, w).select("window", "code", "at", F.col("reverse").alias("_t")).join(named.drop("sequence"), "window")
    one = asked.select("gene", "code", "query_id", F.col("length").alias("query_length"), F.col("at").alias("query_at"), F.col("reverse").alias("_q"))
    met = found.join(one, ["gene", "code"])
    place = (F.col("window_start") + F.col("at")).alias("target_at")
    return met.select("query_id", "query_length", "query_at", "contig", F.col("contig_length").alias("target_length"), place, (F.col("_q") != F.col("_t")).alias("reverse")).distinct()


def best_chain(q: np.ndarray, t: np.ndarray, k: int, max_gap: int, band: int) -> tuple[np.ndarray, int]:
    """(places, score) of the best chain of anchors sorted by (t, q): q and t rise, by max_gap at most and alike to within band.

    An anchor adds the bases, k at most, by which the nearer of q and t moves on.  Ties: the earlier predecessor, the earlier end.
    """
    score, back = np.full(len(q), k, np.int64), np.full(len(q), -1)
    first = np.searchsorted(t, t - max_gap)
    for i in range(len(q)):
        j = slice(first[i], i)
        dq, dt = q[i] - q[j], t[i] - t[j]
        fits = (dq > 0) & (dt > 0) & (dq <= max_gap) & (np.abs(dt - dq) <= band)
        if fits.any():
            reach = np.where(fits, score[j] + np.minimum(k, np.minimum(dq, dt)), -1)
            top = int(np.argmax(reach))
            if reach[top] > score[i]:
                score[i], back[i] = reach[top], first[i] + top
    end = int(np.argmax(score))
    chain, at = [], end
    while at >= 0:
        chain.append(at)
        at = back[at]
    return np.array(chain[::-1]), int(score[end])


def seed_islands(seeds: DataFrame, keys: list[str], max_gap: int, band: int, rounds: int = 2) -> DataFrame:
    """seeds (keys, _q, _t) with _group: anchors that no chain can join are in different groups.

    A chain's steps are at most max_gap on the target and `band` across diagonals, so seeds are cut at wider gaps of either, in turn.
    """
    cut, held = seeds, list(keys)
    for k in range(rounds):
        for name, value, reach in ((f"_a{k}", F.col("_t"), max_gap), (f"_b{k}", F.col("_t") - F.col("_q"), band)):
            placed = cut.withColumn("_s", value).withColumn("_e", value + reach)
            cut = islands(placed, held, "_s", "_e", touching=True, name=name, bin_size=BIN).drop("_s", "_e")
            held.append(name)
    return cut.withColumn("_group", F.struct(*held[len(keys) :])).drop(*held[len(keys) :])


def seed_chains(
    seeds: DataFrame, query_id: str, target_id: str, k: int, max_gap: int = 1000, band: int = 500, least_anchors: int = 3, least_score: int = 40
) -> DataFrame:
    """query_id, query_length, query_start, query_end, strand, target_id, target_length, target_start, target_end, bases, anchors of every chain.

    The best chain of a group of seeds (see best_chain) takes its anchors, and the next is found among the rest, as long as they have
    least_anchors and least_score; bases is the score, the number of query bases that anchors cover.  Queries of the `-` strand are turned
    round for chaining, and their places are given as on the query itself, as PAF has them.  Repeated seeds count once.
    """
    turned = F.when(F.col("reverse"), F.col("query_length") - k - F.col("query_at")).otherwise(F.col("query_at"))
    keys = [query_id, target_id, "reverse"]
    rows = seeds.select(*keys, "query_length", "target_length", turned.alias("_q"), F.col("target_at").alias("_t")).distinct()
    placed = seed_islands(written(rows, "anchors"), keys, max_gap, band)
    lengths = F.max("query_length").alias("query_length"), F.max("target_length").alias("target_length")
    anchors = F.array_sort(F.collect_list(F.struct("_t", "_q"))).alias("anchors")
    groups = placed.groupBy(*keys, "_group").agg(*lengths, anchors).where(F.size("anchors") >= least_anchors)
    kinds = [seeds.schema[c].dataType.simpleString() for c in (query_id, target_id)]
    schema = f"q {kinds[0]}, t {kinds[1]}, reverse boolean, query_length long, target_length long, low long, high long, target_start long, target_end long, bases long, anchors long"
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            facts = [batch.column(c).to_pylist() for c in (query_id, target_id, "reverse", "query_length", "target_length")]
            out = []
            for row, anchors in enumerate(batch.column("anchors")):
                t, q = (f.to_numpy() for f in anchors.values.flatten())
                while len(q) >= least_anchors:
                    places, bases = best_chain(q, t, k, max_gap, band)
                    if bases < least_score:
                        break
                    if len(places) >= least_anchors:
                        ends = int(q[places[0]]), int(q[places[-1]]) + k, int(t[places[0]]), int(t[places[-1]]) + k
                        out.append((*[f[row] for f in facts], *ends, bases, len(places)))
                    q, t = np.delete(q, places), np.delete(t, places)
            columns = list(zip(*out, strict=True)) or [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    made = groups.select(*keys, "query_length", "target_length", "anchors").mapInArrow(chain, schema)
    start = F.when(F.col("reverse"), F.col("query_length") - F.col("high")).otherwise(F.col("low"))
    end = F.when(F.col("reverse"), F.col("query_length") - F.col("low")).otherwise(F.col("high"))
    return made.select(
        F.col("q").alias(query_id), "query_length", start.alias("query_start"), end.alias("query_end"), F.when(F.col("reverse"), "-").otherwise("+").alias("strand"),
        F.col("t").alias(target_id), "target_length", "target_start", "target_end", "bases", "anchors",
    )


def best_candidates(chains: DataFrame, query_id: str, most: int) -> DataFrame:
    """The `most` chains of each query with the most bases; ties by place."""
    order = Window.partitionBy(query_id).orderBy(F.desc("bases"), *[c for c in chains.columns if c not in (query_id, "bases")])
    return chains.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= most).drop("_rank")
