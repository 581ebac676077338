"""Gene and transcript calls from exon alignments: hits, blocks, chains, resolution, hierarchy, routing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from lociweave.functions.scalars import exon_score, gap_limit
from lociweave.operators.chains import chain_places, resolve, scored, tie_name, tied_places
from lociweave.operators.intervals import bins_for, islands
from lociweave.operators.ranking import gapless_index
from lociweave.operators.transcript_chains import MOST_WIDE, transcript_chains
from lociweave.plans.annotation import Annotation, with_full_genes
from lociweave.plans.evidence import block_scores, expected_exons, hits_of, known_exons, non_overlapping, with_blocks
from lociweave.plans.resolution import resolved_in_rounds
from lociweave.storage import input_width, together, written

HIT = (
    "struct<number: int, exon_id: string, start: long, end: long, block_start: long, block_end: long, score: double, length: long, exon_score: double, "
    "bases: long, identity: double, coverage: double, alignment_score: double, exon_start: long, exon_end: long, ref_chrom: string, ref_start: long, ref_end: long, "
    "supplier_exon_id: string, supplier_length: long>"
)
CALL_HIT = HIT[:-1] + ", inserted: boolean>"
FACTS = (
    "query_id string, strand string, tid string, transcript_id_full string, gene string, gene_id string, gene_id_full string, gene_name string, "
    "transcript_type string, model_type string, mane boolean, coding boolean, exon_length long, expected int, expected_numbers array<int>, max_gap long"
)
CALLS = f"{FACTS}, parent string, coding_x double, complete_x double, mane_x double, hits array<{CALL_HIT}>, raw double, weighted double, found array<int>, runs array<int>"
SELECTED = f"{CALLS}, tie_group_id string, tie_count int"


#: Bases of a query whose hits are put into blocks by one task.
BIN = 1_000_000


@dataclass(frozen=True)
class Options:
    two_stage: bool = True
    prefer_mane: bool = True
    coding_bonus: float = 10.0
    complete_bonus: float = 2.0
    mane_bonus: float = 1.0
    max_chains: int = 10
    shared_bases: int = 100

    def __post_init__(self):
        checks = {
            "bonuses are finite and above 0": all(0 < x < float("inf") for x in (self.coding_bonus, self.complete_bonus, self.mane_bonus)),
            "max_chains is at least 1": self.max_chains >= 1,
            "shared_bases is not below 0": self.shared_bases >= 0,
        }
        if failed := [rule for rule, held in checks.items() if not held]:
            raise ValueError("; ".join(failed))


#: Arrow bytes that become Python objects at a time, which take some twenty times as much.
SLICE_BYTES = 1 << 20


def _slices(batch: pa.RecordBatch, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about `size` bytes, SLICE_BYTES by default."""
    rows = max(1, batch.num_rows * (size or SLICE_BYTES) // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _map_rows(df: DataFrame, f: Callable[[dict], list[dict]], schema: str) -> DataFrame:
    """Rows made by f from each row of df, both as dicts; a batch of any size becomes Python objects a slice at a time."""
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                made = [{n: x.get(n) for n in arrow.names} for row in part.to_pylist() for x in f(row)]
                yield pa.RecordBatch.from_pylist(made, schema=arrow)

    return df.mapInArrow(run, schema)


def scored_hits(alignments: DataFrame, a: Annotation, eligible: DataFrame | None = None, region: tuple[str, int, int] | None = None) -> DataFrame:
    """Hits of known exons with their block and their gene's score in it."""
    assoc = a.assoc()
    known = known_exons(alignments, assoc)
    known = known.withColumn("_score", exon_score(F.col("exon_length"), F.col("identical_bases")))
    kept = non_overlapping(known, ["query_id", "strand", "exon_id"], "query_start", "query_end", [-F.col("_score"), -F.col("aligned_exon_bases"), -F.col("AS")])
    kept = written(kept, "evidence")
    expected = expected_exons(assoc, eligible, region)
    gene = F.when(F.col("gene_id") != "", F.col("gene_id")).when(F.col("gene_name") != "", F.col("gene_name")).otherwise(F.concat(F.lit("transcript:"), "tid"))
    rows = hits_of(kept, assoc, expected).join(a.transcripts.select("tid", gene.alias("gene")), "tid")
    placed = written(with_blocks(rows, "query_start", "query_end", bin_size=BIN), "hits")
    best = block_scores(placed, "gene", "exon_length", "identical_bases", ["exon_id", "query_start", "query_end"])
    best = best.select("query_id", "strand", "block_id", "gene", "score", "supplier_length", "supplier_exon_id")
    return placed.join(best, ["query_id", "strand", "block_id", "gene"])


def chain_groups(hits: DataFrame, a: Annotation, expected: DataFrame, extra: list[str] = ()) -> DataFrame:
    """One row a query, strand and model (and `extra` keys): the facts of the model and its hits, sorted by place."""
    hit = F.struct(
        F.col("exon_number").cast("int").alias("number"), "exon_id", F.col("query_start").alias("start"), F.col("query_end").alias("end"), "block_start", "block_end", "score",
        F.col("exon_length").alias("length"), F.col("_score").alias("exon_score"), F.col("aligned_exon_bases").alias("bases"), F.col("percent_identity").alias("identity"),
        F.col("exon_coverage").alias("coverage"), F.col("AS").alias("alignment_score"), "exon_start", "exon_end", F.col("chrom").alias("ref_chrom"), F.col("start0").alias("ref_start"),
        F.col("end0").alias("ref_end"), "supplier_exon_id", "supplier_length",
    )
    order = F.struct(F.col("query_start"), F.col("query_end"), F.col("exon_id"), F.col("exon_number"), hit.alias("hit"))
    groups = hits.groupBy(*extra, "query_id", "strand", "tid", "gene").agg(F.array_sort(F.collect_list(order)).alias("h"))
    span = a.exons.groupBy("tid").agg(gap_limit(F.max("end0") - F.min("start0")).alias("max_gap"))
    facts = a.transcripts.withColumn("coding", F.col("transcript_type") == "protein_coding").withColumnRenamed("gene_id", "_gene_id")
    met = groups.join(facts, "tid").join(expected, "tid").join(span, "tid")
    return met.select(
        *extra, "query_id", "strand", "tid", "transcript_id_full", "gene", F.col("_gene_id").alias("gene_id"), "gene_id_full", "gene_name", "transcript_type", "model_type", "mane", "coding",
        F.col("exon_length").cast("long").alias("exon_length"), F.size("numbers").alias("expected"), F.col("numbers").alias("expected_numbers"), "max_gap", F.col("h.hit").alias("hits"),
    )


#: What chaining and its score read of a hit and of a group; all else passes as Arrow columns.
_READ = ("number", "exon_id", "start", "end", "block_start", "block_end", "score", "length", "exon_score", "bases")
_WIDE = ("number", "start", "end", "block_start", "block_end", "score", "bases")
_ASKED = ("strand", "model_type", "max_gap", "coding", "mane", "expected")
#: Arrow bytes of the groups that are chained together.
CHAINED_BYTES = 8 << 20


def _widths(batch: pa.RecordBatch, starts: np.ndarray) -> dict[int, np.ndarray]:
    """Rows of transcript groups by number of hits, where as many have it that they are chained together: few hits, none empty, no cell null."""
    values, sizes = batch.column("hits").values, np.diff(starts)
    own = slice(int(starts[0]), int(starts[-1]))
    if any(values.field(n)[own].null_count for n in _WIDE) or any(batch.column(n).null_count for n in ("strand", "model_type")):
        return {}
    empty = np.flatnonzero(values.field("end")[own].to_numpy() <= values.field("start")[own].to_numpy()) + own.start
    fit = (sizes > 0) & (sizes <= MOST_WIDE) & pc.not_equal(batch.column("model_type"), "full_gene").to_numpy(zero_copy_only=False)
    fit[np.searchsorted(starts, empty, "right") - 1] = False
    of = {n: np.flatnonzero(fit & (sizes == n)) for n in np.unique(sizes[fit]).tolist()}
    return {n: rows for n, rows in of.items() if len(rows) >= 2 * n or n < 3}


def _chained(batch: pa.RecordBatch, facts: list[str], arrow: pa.Schema, coding_bonus: float, o: Options) -> pa.RecordBatch:
    """The chains of a batch of groups: rows of facts and hits are taken by place, so that they never become Python objects.

    Groups of one number of hits are chained together; genes and what is left over become lists, one group at a time.
    """
    hits = batch.column("hits")
    base, fields = hits.values, [f.name for f in hits.type.value_type]
    starts = hits.offsets.to_numpy().astype(np.int64)
    asked = {n: batch.column(n) for n in _ASKED}
    parts: list[tuple[np.ndarray, ...]] = []  # group, sizes, places, inserted, raw, found sizes, found, runs sizes, runs
    wide, done = _widths(batch, starts), np.zeros(batch.num_rows, bool)
    if wide:
        read = {n: base.field(n).to_numpy(zero_copy_only=False) for n in _WIDE}
        plus = pc.equal(asked["strand"], "+").to_numpy(zero_copy_only=False)
    for width, rows in wide.items():
        at = starts[rows][:, None] + np.arange(width)
        x, forward = {n: read[n][at] for n in _WIDE}, plus[rows][:, None]
        low, high = np.where(forward, x["start"], -x["end"]), np.where(forward, x["end"], -x["start"])
        c = transcript_chains(x["number"], low, high, x["block_start"], x["block_end"], x["score"], x["bases"], o.max_chains)
        group = rows[c.group]
        places = np.repeat(starts[group], c.sizes) + c.places
        # numbers rise along a chain, so those found are its own, in order
        parts.append((group, c.sizes, places, np.zeros(len(places), bool), c.raw, c.sizes, read["number"][places], np.zeros(len(group), np.int64), np.zeros(0, np.int64)))
        done[rows] = True
    rows, sizes, places, inserted, raws, found, runs = [], [], [], [], [], [], []
    for row in np.flatnonzero(~done).tolist():
        a, b = int(starts[row]), int(starts[row + 1])
        own = [dict(zip(_READ, values, strict=True)) for values in zip(*[base.field(n).slice(a, b - a).to_pylist() for n in _READ], strict=True)]
        call = {n: asked[n][row].as_py() for n in _ASKED} | {"coding_x": coding_bonus, "complete_x": o.complete_bonus, "mane_x": o.mane_bonus}
        for chain in chain_places(own, call["strand"], call["model_type"], call["max_gap"], o.max_chains):
            score = scored(call, [{**own[i], "inserted": extra} for i, extra in chain])
            rows.append(row)
            sizes.append(len(chain))
            places += [a + i for i, _ in chain]
            inserted += [extra for _, extra in chain]
            raws.append(score["raw"])
            found.append(score["found"])
            runs.append(score["runs"])
    flat = lambda lists: (np.array([len(v) for v in lists], np.int64), np.array([n for v in lists for n in v], np.int64))
    parts.append((np.array(rows, np.int64), np.array(sizes, np.int64), np.array(places, np.int64), np.array(inserted, bool), np.array(raws, float), *flat(found), *flat(runs)))
    group, sizes, places, inserted, raw, n_found, found, n_runs, runs = [np.concatenate(x) for x in zip(*parts, strict=True)]
    ends = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
    listed = lambda n, values, name: pa.ListArray.from_arrays(ends(n), pa.array(values, arrow.field(name).type.value_type))
    kept = pa.array(group, pa.int64())
    flag = lambda n: pc.fill_null(asked[n], False).to_numpy(zero_copy_only=False)[group]
    expected = pc.fill_null(asked["expected"], 0).to_numpy(zero_copy_only=False)[group]
    weighted = raw
    for on, times in ((flag("coding"), coding_bonus), ((expected > 0) & (expected <= n_found), o.complete_bonus), (flag("mane"), o.mane_bonus)):
        weighted = weighted * np.where(on, times, 1.0)
    taken = base.take(pa.array(places, pa.int64()))
    types = arrow.field("hits").type.value_type
    items = pa.StructArray.from_arrays([taken.field(n) for n in fields] + [pa.array(inserted, pa.bool_())], fields=list(types))
    same = lambda v: pa.array(np.full(len(group), v), pa.float64())
    columns = {n: batch.column(n).take(kept) for n in facts} | {
        "hits": pa.ListArray.from_arrays(ends(sizes), items), "coding_x": same(coding_bonus), "complete_x": same(o.complete_bonus), "mane_x": same(o.mane_bonus),
        "raw": pa.array(raw), "weighted": pa.array(weighted), "found": listed(n_found, found, "found"), "runs": listed(n_runs, runs, "runs"),
    }
    columns.setdefault("parent", pa.nulls(len(group), pa.string()))
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in arrow], schema=arrow)


def chains(groups: DataFrame, coding_bonus: float, o: Options) -> DataFrame:
    """All chains of every group, scored; groups are read once, where they were made."""

    arrow = to_arrow_schema(_parse_datatype_string(CALLS))
    facts = [f.name for f in arrow if f.name in groups.columns and f.name != "hits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, CHAINED_BYTES):
                yield _chained(part, facts, arrow, coding_bonus, o)

    return groups.mapInArrow(run, CALLS)


#: What resolution reads of a hit and of a call, besides its keys, and what it gives back for a call.
LEAN = ("number", "exon_id", "start", "end", "block_start", "block_end", "score", "inserted")
READ = ("tid", "transcript_id_full", "gene", "gene_id_full", "mane", "coding", "exon_length", "expected", "coding_x", "complete_x", "mane_x", "raw", "weighted", "found", "runs")
_KEPT = "_id long, _left array<int>, raw double, weighted double, found array<int>, runs array<int>, tie_group_id string, tie_count int"
_MADE = ("raw", "weighted", "found", "runs", "tie_group_id", "tie_count")


def lean(calls: DataFrame) -> DataFrame:
    """calls with no more than resolution reads."""
    return calls.select("query_id", "strand", *READ, F.transform("hits", lambda h: F.struct(*[h[n].alias(n) for n in LEAN])).alias("hits"))


def _contested(key: np.ndarray, sizes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each call whether it has a block with another call of its key; sizes: hits of each call, starts and ends: the blocks of these hits."""
    call = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((call, ends, starts, key[call]))
    call, starts, ends = call[order], starts[order], ends[order]
    place = np.cumsum((np.diff(key[call], prepend=-1) != 0) | (np.diff(starts, prepend=0) != 0) | (np.diff(ends, prepend=0) != 0))
    first, last = np.searchsorted(place, place, "left"), np.searchsorted(place, place, "right") - 1
    met = np.zeros(len(sizes), bool)
    met[call[call[first] != call[last]]] = True
    return met


def _competed(batch: pa.RecordBatch, keys: list[str], arrow: pa.Schema, prefer_mane: bool) -> pa.RecordBatch:
    """The selected calls of a batch of keys, each with all its calls: rows and hits are taken by place, only calls that others contest become Python objects.

    Calls compete with those that they share blocks with, directly or through others, in the order of their names and places.
    """
    base, starts = batch.column("calls").values, batch.column("calls").offsets.to_numpy().astype(np.int64)
    base = base.slice(int(starts[0]), int(starts[-1] - starts[0]))
    key = np.repeat(np.arange(batch.num_rows), np.diff(starts))
    column = lambda n, at: batch.column(n).take(pa.array(key[at])) if n in keys else base.field(n).take(pa.array(at))
    hits, offsets = base.field("hits").values, base.field("hits").offsets.to_numpy().astype(np.int64)
    sizes = np.diff(offsets)
    blocks = [hits.field(n).slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_numpy(zero_copy_only=False) for n in ("block_start", "block_end")]
    met = _contested(key, sizes, *blocks)
    places = lambda at: np.repeat(offsets[at], sizes[at]) + np.arange(sizes[at].sum()) - np.repeat(np.cumsum(sizes[at]) - sizes[at], sizes[at])
    alone, open_ = np.flatnonzero(~met & (sizes > 0)), np.flatnonzero(met)
    taken = hits.take(pa.array(places(open_)))
    own = iter(zip(places(open_).tolist(), *[taken.field(n).to_pylist() for n in LEAN], strict=True))
    facts = dict.fromkeys(["query_id", "strand", "_id", *READ])
    of: dict[int, list[dict]] = {}
    for at, k, n, *values in zip(open_.tolist(), key[open_].tolist(), sizes[open_].tolist(), *[column(n, open_).to_pylist() for n in facts], strict=True):
        listed = [{"at": place, **dict(zip(LEAN, cells, strict=True))} for place, *cells in islice(own, n)]
        of.setdefault(k, []).append(dict(zip(facts, values, strict=True)) | {"_at": at, "hits": listed})
    won: list[dict] = []
    for calls in of.values():
        calls.sort(key=lambda c: (c["tid"] or "", [h["start"] for h in c["hits"]], c["_id"]))
        for rivals in tied_places(calls):
            won += resolve([calls[i] for i in rivals], prefer_mane)
    kept = np.concatenate([alone, np.array([c["_at"] for c in won], np.int64)])
    left = np.concatenate([places(alone), np.array([h["at"] for c in won for h in c["hits"]], np.int64)])
    ends = np.concatenate([[0], np.cumsum(np.concatenate([sizes[alone], np.array([len(c["hits"]) for c in won], np.int64)]))])
    calm = {"tie_group_id": pa.array([""] * len(alone)), "tie_count": pa.array([1] * len(alone), pa.int32())}
    columns = {"hits": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), hits.take(pa.array(left)))}
    for f in arrow:
        if f.name in _MADE:
            same = calm[f.name] if f.name in calm else column(f.name, alone)
            columns[f.name] = pa.concat_arrays([same.cast(f.type), pa.array([c[f.name] for c in won], f.type)])
        elif f.name != "hits":
            columns[f.name] = column(f.name, kept)
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in arrow], schema=arrow)


def _resolved_by_key(calls: DataFrame, width: int, prefer_mane: bool, keys: list[str]) -> DataFrame:
    """The selected calls, where no key has more of them than a task can hold: calls are dealt once, by their keys."""
    schema = StructType([f for f in calls.schema if f.name != "_id"] + list(_parse_datatype_string("tie_group_id string, tie_count int")))
    arrow = to_arrow_schema(schema)
    own = F.struct(*[c for c in calls.columns if c not in keys])
    gathered = together(calls, width, keys).groupBy(*keys).agg(F.collect_list(own).alias("calls"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                yield _competed(part, keys, arrow, prefer_mane)

    return written(gathered.mapInArrow(run, schema), "competed")


def _from_rounds(calls: DataFrame, prefer_mane: bool, keys: list[str]) -> DataFrame:
    """What resolution in rounds selects, as _KEPT rows; only calls that tie are put together for their group's name."""
    made = written(resolved_in_rounds(calls, prefer_mane, keys), "selected")
    ties = made.where("tie_count > 1").groupBy("component").agg(F.collect_list(F.struct("query_id", "strand", "gene_id_full", "transcript_id_full", "hits")).alias("calls"))
    names = _map_rows(ties, lambda row: [{"component": row["component"], "tie_group_id": tie_name(row["calls"])}], "component long, tie_group_id string")
    met = made.join(names, "component", "left")
    return met.select(
        "_id", F.transform("hits", lambda h: h["at"]).alias("_left"), "raw", "weighted", "found", F.array().cast("array<int>").alias("runs"),
        F.coalesce("tie_group_id", F.lit("")).alias("tie_group_id"), F.col("tie_count").cast("int").alias("tie_count"),
    )


def resolved(calls: DataFrame, prefer_mane: bool, keys: tuple[str, ...] = ("query_id", "strand"), bin_size: int = 1_000_000, most_at_once: int = 5000) -> DataFrame:
    """Selected calls of each query and strand (and parent), with tie_group_id and tie_count.

    The calls of a key of at most most_at_once calls meet in one task; larger keys are cut into islands of overlapping calls (_resolved_by_island).
    """
    calls = written(calls.withColumn("_id", F.monotonically_increasing_id()), "candidates")
    width = input_width(calls)
    large = written(calls.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > most_at_once).drop("_n"), "large")
    if large.isEmpty():
        return _resolved_by_key(calls, width, prefer_mane, list(keys))
    is_large = reduce(lambda x, y: x & y, [calls[k].eqNullSafe(large[k]) for k in keys])
    few = _resolved_by_key(calls.join(F.broadcast(large), is_large, "left_anti"), width, prefer_mane, list(keys))
    return few.unionByName(_resolved_by_island(written(calls.join(F.broadcast(large), is_large, "left_semi"), "crowded"), prefer_mane, keys, bin_size, most_at_once))


def _resolved_by_island(calls: DataFrame, prefer_mane: bool, keys: tuple[str, ...], bin_size: int, most_at_once: int) -> DataFrame:
    """The selected calls of keys of any size.

    A call none of whose blocks is in another call is selected as it is and stays in the plan.  The others compete within
    islands of overlapping calls, since calls that share a block overlap; only what competition needs travels there.  An island of more than
    most_at_once calls is resolved in rounds of joins (plans.resolution), unless it has inserted hits or scores below zero, whose calls can rise.
    """
    blocks = calls.select("_id", *keys, F.explode(F.array_distinct(F.transform("hits", lambda h: F.struct(h["block_start"].alias("s"), h["block_end"].alias("e"))))).alias("b"))
    shared = blocks.groupBy(*keys, "b").agg(F.count("*").alias("n"), F.min("_id").alias("_one")).where("n > 1")
    same = [blocks[k].eqNullSafe(shared[k]) for k in keys]
    contested = blocks.join(shared, [*same, blocks["b"] == shared["b"]], "left_semi").select("_id").distinct()
    contested = written(contested, "contested")
    alone = calls.join(contested, "_id", "left_anti").where("size(hits) > 0")
    alone = alone.withColumns({"tie_group_id": F.lit(""), "tie_count": F.lit(1)})
    hits = F.transform("hits", lambda h, i: F.struct(*[h[n].alias(n) for n in LEAN], i.alias("at")))
    rivals = calls.join(contested, "_id").select("_id", *keys, *READ, hits.alias("hits"), F.array_min("hits.block_start").alias("_from"), F.array_max("hits.block_end").alias("_until"))
    placed = islands(rivals, list(keys), "_from", "_until", name="_island", bin_size=bins_for(calls, list(keys), bin_size))
    island = [*keys, "_island"]
    placed = written(placed, "placed")
    odd = F.exists("hits", lambda h: h["inserted"] | (h["score"] < 0))
    crowds = written(placed.groupBy(*island).agg(F.count("*").alias("_n"), F.bool_or(odd).alias("_odd")).where((F.col("_n") > most_at_once) & ~F.col("_odd")).drop("_n", "_odd"), "crowds")
    crowded = not crowds.isEmpty()
    in_crowd = reduce(lambda x, y: x & y, [placed[k].eqNullSafe(crowds[k]) for k in island])
    few = placed.join(crowds, in_crowd, "left_anti") if crowded else placed
    call = F.struct("tid", F.col("hits.start").alias("starts"), "_id", F.struct("_id", "query_id", "strand", *READ, "hits").alias("call"))
    gathered = few.groupBy(*island).agg(F.array_sort(F.collect_list(call)).alias("c"))

    def one(row: dict) -> list[dict]:
        return [{**c, "_left": [h["at"] for h in c["hits"]]} for c in resolve(row["calls"], prefer_mane)]

    kept = _map_rows(gathered.select(F.col("c.call").alias("calls")), one, _KEPT)
    kept = written(kept, "kept")
    if crowded:
        kept = kept.unionByName(_from_rounds(placed.join(crowds, in_crowd, "left_semi").drop("_from", "_until"), prefer_mane, island))
    won = calls.drop("raw", "weighted", "found", "runs").join(kept, "_id").withColumn("hits", F.transform("_left", lambda i: F.get("hits", i)))
    return won.select(*alone.columns).unionByName(alone).drop("_id")


def hierarchical_calls(hits: DataFrame, a: Annotation, expected: DataFrame, o: Options) -> DataFrame:
    """Genes first, by full-gene models; then their isoforms, each inside one parent's blocks.

    Rows have parent (digest of the gene assignment), sort_score, hull_start, hull_end.
    """
    models = a.transcripts.select("tid", "model_type", F.col("gene_id").alias("model_gene"))
    typed = written(hits.join(models, "tid"), "typed")
    genes = resolved(chains(chain_groups(typed.where("model_type = 'full_gene'").drop("model_type", "model_gene"), a, expected), 1.0, o), False)
    group = F.when(F.col("tie_group_id") != "", F.col("tie_group_id")).otherwise(F.sha2(F.to_json(F.struct("query_id", "strand", "tid", "hits.start", "hits.end")), 256))
    genes = written(genes.withColumn("parent", group), "genes")
    blocks = genes.select("parent", "query_id", "strand", "gene_id", "tid", "weighted", F.explode("hits").alias("h"))
    hull = blocks.groupBy("parent").agg(F.max("weighted").alias("sort_score"), F.min("h.block_start").alias("hull_start"), F.max("h.block_end").alias("hull_end"))
    # a child is a transcript of the gene that has one of the model's exons at the same place
    places = a.exons.join(models, "tid").select("tid", "model_type", "model_gene", "exon_id", "chrom", "start0", "end0")
    full = places.where("model_type = 'full_gene'").select(F.col("tid").alias("model"), "model_gene", "exon_id", "chrom", "start0", "end0")
    allowed = places.where("model_type = 'transcript'").drop("model_type").join(full, ["model_gene", "exon_id", "chrom", "start0", "end0"]).select("model", "tid").distinct()
    owners = blocks.select("parent", "query_id", "strand", F.col("tid").alias("model")).distinct().join(allowed, "model").select("parent", "query_id", "strand", "tid").distinct()
    inside = blocks.select("parent", F.col("h.block_start").alias("block_start"), F.col("h.block_end").alias("block_end")).distinct()
    children = typed.where("model_type = 'transcript'").join(owners, ["query_id", "strand", "tid"]).join(inside, ["parent", "block_start", "block_end"])
    raw = chains(chain_groups(children.drop("model_type", "model_gene"), a, expected, ["parent"]), o.coding_bonus, o)
    found = resolved(raw, o.prefer_mane, ("parent", "query_id", "strand"))
    return genes.unionByName(found).join(hull, "parent")


def call_genes(
    alignments: DataFrame, a: Annotation, o: Options = Options(), eligible: DataFrame | None = None, region: tuple[str, int, int] | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """(calls, full-gene report).  calls: selected gene and transcript copies with their group's order and routing.

    gene_number counts assignments in output order (best gene score first); is_fragment marks assignments whose parents
    are all partial with one matched block and that have no complete MANE child.
    """
    report = None
    if o.two_stage:
        a, report = with_full_genes(a, o.shared_bases)
    hits = scored_hits(alignments, a, eligible, region)
    expected = expected_exons(a.assoc(), eligible, region)
    if o.two_stage:
        calls = hierarchical_calls(hits, a, expected, o)
    else:
        raw = chains(chain_groups(hits, a, expected), o.coding_bonus, o)
        group = F.when(F.col("tie_group_id") != "", F.col("tie_group_id")).otherwise(F.sha2(F.to_json(F.struct("query_id", "strand", "tid", "hits.start", "hits.end")), 256))
        calls = resolved(raw, o.prefer_mane).withColumn("parent", group)
        hull = calls.groupBy("parent").agg(F.max("weighted").alias("sort_score"), F.min(F.array_min("hits.block_start")).alias("hull_start"), F.max(F.array_max("hits.block_end")).alias("hull_end"))
        calls = calls.join(hull, "parent")
    return routed(written(calls, "calls"), o.two_stage), report


def routed(calls: DataFrame, two_stage: bool) -> DataFrame:
    """calls with complete, is_fragment and gene_number."""
    complete = (F.col("expected") > 0) & (F.size("found") >= F.col("expected"))
    marked = calls.withColumn("complete", complete)
    is_parent = F.col("model_type") == "full_gene"
    matched = F.size(F.array_distinct(F.transform(F.filter("hits", lambda h: ~h["inserted"]), lambda h: F.struct(h["block_start"], h["block_end"]))))
    lone = ~F.col("complete") & (matched == 1)
    groups = marked.groupBy("parent").agg(
        (F.bool_and(~is_parent | lone) & ~F.bool_or(~is_parent & F.col("complete") & F.col("mane"))).alias("is_fragment"), F.max("sort_score").alias("s"),
        F.max("query_id").alias("q"), F.min("hull_start").alias("a"), F.min("hull_end").alias("b"),
    )
    if not two_stage:
        groups = groups.withColumn("is_fragment", F.lit(False))
    numbered = gapless_index(groups, [], [F.desc("s"), F.desc("q"), "a", "b", F.desc("parent")], "_number")
    return marked.join(numbered.select("parent", "is_fragment", (F.col("_number") + 1).alias("gene_number")), "parent")


def decisions(calls: DataFrame, prefer_mane: bool, keys: tuple[str, ...] = ("query_id", "strand"), bin_size: int = 1_000_000) -> DataFrame:
    """What happened to each call, in order: (query_id, strand, island, step, event, tid, weighted, n_hits); events are trim,
    isoform_tiebreak and select.  Calls of different islands of overlapping calls do not meet, so steps count within an island (1, 2, ... along
    the query); calls without hits have no event."""
    held = calls.where("size(hits) > 0").withColumns({"_from": F.array_min("hits.block_start"), "_until": F.array_max("hits.block_end")})
    placed = islands(held, list(keys), "_from", "_until", name="_island", bin_size=bin_size)
    call = F.struct("tid", F.col("hits").getField("start").alias("at"), F.struct(*calls.columns).alias("call"))
    gathered = placed.groupBy(*keys, "_island").agg(F.array_sort(F.collect_list(call)).alias("c"))

    def log(row: dict) -> list[dict]:
        events: list[dict] = []
        resolve(row["calls"], prefer_mane, events)
        facts = lambda c: {"query_id": c["query_id"], "strand": c["strand"], "island": row["_island"], "tid": c["tid"], "weighted": c["weighted"], "n_hits": len(c["hits"])}
        return [{"step": k, "event": e["event"], **facts(e["call"])} for k, e in enumerate(events)]

    schema = "query_id string, strand string, island long, step int, event string, tid string, weighted double, n_hits int"
    return _map_rows(gathered.select("_island", F.col("c.call").alias("calls")), log, schema)
