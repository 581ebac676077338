"""Sequence search: exact seeds, candidate windows, and the projection of gapped alignments onto exons."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from lociweave.functions.scalars import window_padding
from lociweave.operators.bit_filter import code_bits, passing
from lociweave.operators.intervals import copy_counts, merged, range_join
from lociweave.operators.ranking import running_total
from lociweave.operators.stretches import with_length, with_stretch
from lociweave.plans.calls import _map_rows
from lociweave.storage import input_width, together, written

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def stretch_codes(text: str, k: int) -> np.ndarray:
    """64-bit hashes of all stretches of k characters, by doubling: a stretch of 2m is made of two of m."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = len(points) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, size, out, done = _mixed(points * _MULTIPLIER), 1, None, 0
    join = lambda a, b: _mixed(a * _MULTIPLIER + b)
    while True:
        if k & size:
            own = power[done : done + n]
            out, done = own if out is None else join(out, own), done + size
        if 2 * size > k:
            return out
        power, size = join(power[: len(power) - size], power[size:]), 2 * size


def shared_kmers(queries: DataFrame, query_id: str, targets: DataFrame, target_id: str, text: str, k: int, step: int = 1) -> DataFrame:
    """(query_id, query_at, target_id, target_at): all pairs of equal stretches of k characters; queries are read every `step`.

    Targets are read once where they stand, through a bit filter of the query stretches' hashes whose size is bounded; only
    stretches that pass are made into rows, met by hash and compared as text.  Texts shorter than k have none.
    """
    spark = targets.sparkSession

    def stretches(df: DataFrame, name: str, stride: int, bits) -> DataFrame:
        rows = df.where(F.length(text) >= k).select(F.col(name).alias("id"), F.col(text).alias("text"))
        schema = f"id {rows.schema['id'].dataType.simpleString()}, at long, code long, mer string"
        arrow = to_arrow_schema(_parse_datatype_string(schema))

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    body = batch.column(1)[row].as_py()
                    codes = stretch_codes(body, k)[::stride]
                    at = np.arange(len(codes))
                    if bits is not None:
                        at = passing(bits.value, codes)
                    places = (at * stride).tolist()
                    for first in range(0, len(places), 1 << 14):
                        part = places[first : first + (1 << 14)]
                        ids = pa.array([batch.column(0)[row].as_py()] * len(part), arrow.field("id").type)
                        own = codes[at[first : first + (1 << 14)]].view(np.int64)
                        yield pa.RecordBatch.from_arrays([ids, pa.array(part, pa.int64()), pa.array(own), pa.array([body[p : p + k] for p in part])], schema=arrow)

        return rows.mapInArrow(read, schema)

    own = written(stretches(queries, query_id, step, None), "stretches")
    bits = code_bits(own.select("code").distinct())
    found = stretches(targets, target_id, 1, spark.sparkContext.broadcast(bits))
    one = own.select(F.col("id").alias(query_id), F.col("at").alias("query_at"), "code", F.col("mer").alias("q_mer"))
    other = found.select(F.col("id").alias(target_id), F.col("at").alias("target_at"), "code", F.col("mer").alias("t_mer"))
    return other.join(one, "code").where("q_mer = t_mer").select(query_id, "query_at", target_id, "target_at")


def query_batches(rows: DataFrame, groups: list[str], order: list[str], size: str, most: int, refuse: bool = False) -> DataFrame:
    """rows with `batch`: which stretch of `most` bytes of its group a row begins in, rows in the order of `order`.

    refuse: a row of more than `most` bytes, for which no batch is large enough, is an error.
    """
    placed = running_total(rows, groups, order, size, "_before")
    batch = F.floor(F.col("_before") / most)
    if refuse:
        batch = F.when(F.col(size) > most, F.raise_error(F.lit("a record is larger than a batch"))).otherwise(batch)
    return placed.withColumn("batch", batch).drop("_before")


def seed_windows(seeds: DataFrame, genes: DataFrame, query_genes: DataFrame) -> DataFrame:
    """(gene, contig, window_start, window_end): seeds padded by 1.5 gene spans on both sides, clipped and merged.

    seeds: query, contig, contig_length, start, end; query_genes: (query, gene); genes: (gene, span).  A query may serve
    several genes; padded windows that touch are one.
    """
    met = seeds.join(query_genes, "query").join(genes, "gene")
    pad = window_padding(F.col("span"))
    padded = met.select("gene", "contig", F.greatest(F.lit(0), F.col("start") - pad).alias("window_start"), F.least("contig_length", F.col("end") + pad).alias("window_end"))
    return merged(padded, ["gene", "contig"], "window_start", "window_end", touching=True).drop("island")


def window_balance(windows: DataFrame, hits: DataFrame, expected: DataFrame, bin_size: int = 100_000) -> DataFrame:
    """windows with `balanced`: every expected exon of the gene has the same number of copies, at least one, in the window.

    hits: gene, contig, exon, strand, start, end, of expected exons, counted where they lie wholly in the window; hits of an
    exon and strand that overlap are one copy.  expected: (gene, exon), unique; a row a gene, with its exons, is broadcast.  A gene
    with no expected exon is not balanced.  A window's hits are counted and joined to it in one of so many partitions as the input's
    files ask for, and a window is not repeated for each exon that it should have.
    """
    place = ["gene", "contig", "window_start", "window_end"]
    met = range_join(hits, windows.select(*place), ["gene", "contig"], bin_size, ("start", "end"), ("window_start", "window_end"), contained=True)
    wanted = expected.distinct().groupBy("gene").agg(F.collect_set("exon").alias("_exons"), F.count("*").alias("_wanted"))
    inside = met.join(F.broadcast(wanted), "gene").where(F.array_contains("_exons", F.col("exon"))).drop("_exons")
    # sorted, counted and joined in one task, hence half as much in each
    width, counted = 2 * input_width(hits, windows), [*place, "_wanted"]
    counts = copy_counts(together(inside, width, place), counted, "exon", "strand", "start", "end", placed=True)
    # every exon found has a copy at least, so all are there where as many are found as are expected
    equal = counts.groupBy(*counted).agg(F.count("*").alias("_found"), F.min("n").alias("_least"), F.max("n").alias("_most"))
    equal = equal.select(*place, ((F.col("_found") == F.col("_wanted")) & (F.col("_least") == F.col("_most"))).alias("balanced"))
    return together(windows, width, place).join(equal, place, "left").withColumn("balanced", F.coalesce("balanced", F.lit(False)))


def search_counters(seeds: DataFrame, genes: DataFrame, query_genes: DataFrame, balance: DataFrame) -> DataFrame:
    """One row: n_seeds, n_genes, n_seeded (genes with a seed), n_windows, n_balanced."""
    seeded = seeds.select("query").distinct().join(query_genes, "query").join(genes.select("gene"), "gene").select("gene").distinct()
    one = lambda df, *aggs: df.agg(*aggs).withColumn("_k", F.lit(1))
    rows = one(seeds, F.count("*").alias("n_seeds"))
    for df, aggs in (
        (genes, [F.count("*").alias("n_genes")]), (seeded, [F.count("*").alias("n_seeded")]),
        (balance, [F.count("*").alias("n_windows"), F.count_if("balanced").alias("n_balanced")]),
    ):
        rows = rows.join(one(df, *aggs), "_k")
    return rows.drop("_k")


def window_sequences(windows: DataFrame, genome: DataFrame) -> DataFrame:
    """windows with their sequence; genome: (name, seq).  A window outside its contig is an error."""
    within = F.expr("window_start >= 0 AND window_start <= window_end AND window_end <= contig_length")
    end = F.when(within, F.col("window_end")).otherwise(F.raise_error(F.lit("a window reaches outside its contig")))
    met = with_length(windows, genome, "contig").withColumn("window_end", end)
    return with_stretch(met, genome, "contig", "window_start", "window_end", "sequence").drop("contig_length")


_CODES = {"A": 1, "C": 2, "G": 4, "T": 8, "U": 8, "R": 5, "Y": 10, "S": 6, "W": 9, "K": 12, "M": 3, "B": 14, "D": 13, "H": 11, "V": 7, "N": 15}
_MASK = np.full(256, 15, np.uint8)
for _letter, _mask in _CODES.items():
    _MASK[ord(_letter)] = _mask

PROJECTED = (
    "exon_start long, exon_end long, target_start long, target_end long, bases long, identity double, identical long, AS double, NM long, cigar string, blast_score double"
)


def runs_of(query: np.ndarray, target: np.ndarray) -> str:
    """CIGAR of two aligned rows of bytes ('-' for gaps): = X I D runs; a gap in the query is an I of the target."""
    kind = np.where(query == 45, 73, np.where(target == 45, 68, np.where(query == target, 61, 88)))
    edge = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]])
    return "".join(f"{n}{chr(kind[at])}" for at, n in zip(edge, np.diff(np.r_[edge, len(kind)]), strict=True))


def _score_table() -> np.ndarray:
    """Twice the score of every two bytes: 2 for one base, -2 where ambiguity codes meet, -4 for a mismatch, -5 beside a gap."""
    meet = (_MASK[:, None] & _MASK[None, :]) > 0
    table = np.where(meet, -2, -4).astype(np.int8)
    bases = np.frombuffer(b"ACGT", np.uint8)
    table[bases, bases] = 2
    table[ord("-"), :] = table[:, ord("-")] = -5
    return table


_TWICE = _score_table()


class Columns:
    """A gapped alignment as a table of its columns: letters of both rows, the place of each (gaps share none), and whether they are equal."""

    def __init__(self, hsp: dict):
        self.letters = [np.frombuffer(hsp[c].upper().encode(), np.uint8) for c in ("qseq", "sseq")]
        self.places = [self._along(row, hsp[a], hsp[b]) for row, a, b in zip(self.letters, ("qstart", "sstart"), ("qend", "send"), strict=True)]
        if len(self.letters[0]) != len(self.letters[1]) or not len(self.letters[0]):
            raise ValueError("coordinates disagree with the aligned strings")
        self.same = (self.letters[0] == self.letters[1]) & (self.places[0] >= 0) & (self.places[1] >= 0)

    @staticmethod
    def _along(row: np.ndarray, first: int, last: int) -> np.ndarray:
        """0-based place of each letter, from 1-based bounds that run down on the reverse strand; -1 for gaps."""
        step = 1 if last >= first else -1
        out = np.full(len(row), -1, np.int64)
        held = np.flatnonzero(row != ord("-"))
        if len(held) != abs(last - first) + 1:
            raise ValueError("coordinates disagree with the aligned strings")
        out[held] = np.arange(first - 1, last - 1 + step, step)
        return out

    def cut(self, start: int, end: int) -> slice:
        """The columns from the first to the last whose query place is in [start, end)."""
        held = np.flatnonzero((self.places[0] >= max(start, 0)) & (self.places[0] < end))
        return slice(int(held[0]), int(held[-1]) + 1) if len(held) else slice(0, 0)


def project(hsp: dict, start: int, end: int) -> dict | None:
    """The part of a gapped alignment that covers query positions [start, end), on the target; None if no target base does.

    Scores: 1 a match, -1 where ambiguity codes meet, -2 a mismatch, -2.5 a gap base, summed and rounded down.
    """
    table = Columns(hsp)
    part = table.cut(start, end)
    (q, t), (at_q, at_t) = [[x[part] for x in pair] for pair in (table.letters, table.places)]
    on_target, on_query = at_t[at_t >= 0], at_q[at_q >= 0]
    if not len(on_target):
        return None
    bounds = {"exon_start": on_query.min() - start, "exon_end": on_query.max() + 1 - start, "target_start": on_target.min(), "target_end": on_target.max() + 1}
    made = {name: int(x) for name, x in bounds.items()}
    n, identical = len(q), int(table.same[part].sum())
    made |= {"identical": identical, "NM": n - identical, "bases": len(on_query), "identity": 100.0 * identical / n}
    return made | {"AS": float(4 * identical - 3 * n), "blast_score": float(int(_TWICE[q, t].sum()) // 2), "cigar": runs_of(q, t)}


def projected(hsps: DataFrame, aliases: DataFrame) -> DataFrame:
    """Alignments of every exon of the queries that were found: hsps (17 tabular columns) joined with aliases
    (query_id, exon_id, core_start, core_end, anchor_start, anchor_end, ...) and cut to each exon.

    selection_score: the alignment's own score where it lies within the exon's anchors, else the score of the part within
    them.  Rows equal in place, exon and cigar are returned once, the first by `ord`.
    """
    met = hsps.join(aliases.withColumnRenamed("query_id", "qseqid"), "qseqid")

    def one(row: dict) -> list[dict]:
        made = project(row, row["core_start"], row["core_end"])
        if made is None:
            return []
        inside = min(row["qstart"], row["qend"]) - 1 >= row["anchor_start"] and max(row["qstart"], row["qend"]) <= row["anchor_end"]
        wide = None if inside else project(row, row["anchor_start"], row["anchor_end"])
        score = row["score"] if inside or wide is None else wide["blast_score"]
        length = row["core_end"] - row["core_start"]
        strand = "+" if (row["qend"] >= row["qstart"]) == (row["send"] >= row["sstart"]) else "-"
        return [made | {"ord": row["ord"], "query_id": row["sseqid"], "exon_id": row["exon_id"], "strand": strand, "exon_length": length,
                        "coverage": 100.0 * made["bases"] / length, "selection_score": float(score), "evalue": row["evalue"]}]

    ord_type = hsps.schema["ord"].dataType.simpleString()
    schema = f"ord {ord_type}, query_id string, exon_id string, strand string, exon_length long, coverage double, selection_score double, evalue double, {PROJECTED}"
    rows = _map_rows(met, one, schema)
    key = ["query_id", "target_start", "target_end", "strand", "exon_id", "exon_start", "exon_end", "cigar"]
    return rows.groupBy(*key).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in key]), "ord").alias("r")).select(*key, "r.*")


def with_aliases(alignments: DataFrame, exons: DataFrame, aliases: DataFrame) -> DataFrame:
    """Alignments of representative exons, given to every exon that a representative stands for.

    alignments: exon_id, strand, exon_start, exon_end, bases, identical and any other columns; exons: the representatives
    (exon_id, chrom, start, end, strand); aliases: representative_id, exon_id, chrom, start, end, strand, length,
    merge_reason.  Where alias and representative overlap on one contig, the aligned part is cut to the alias and turned
    to its strand; elsewhere exon positions carry over as far as the alias is long.  An alignment without aliases or
    representative, or whose aliases all lie outside the aligned part, stays as it is.  Adds exon_length and coverage
    (null for rows that stay).  Aliases of one representative travel as one array, so each side is shuffled once.
    """
    fields = ["exon_id", "chrom", "start", "end", "strand", "length", "merge_reason"]
    listed = aliases.groupBy(F.col("representative_id").alias("_by")).agg(F.collect_list(F.struct(*fields)).alias("_aliases"))
    place = exons.select(F.col("exon_id").alias("_of"), F.struct("chrom", "start", "end", "strand").alias("_rep"))
    met = alignments.join(listed, F.col("exon_id") == F.col("_by"), "left").join(place, F.col("exon_id") == F.col("_of"), "left")
    rep, zero = F.col("_rep"), F.lit(0).cast("long")
    span = lambda low, high: F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"))
    both = lambda x, y: span(F.greatest(x["low"], y["low"]), F.least(x["high"], y["high"]))
    # a stretch of an exon turned into one of the genome or back: from its left end, or from its right end on the reverse strand
    turn = lambda x, exon: F.when(exon["strand"] == "-", span(exon["end"] - x["high"], exon["end"] - x["low"]))
    onto = lambda x, exon: turn(x, exon).otherwise(span(exon["start"] + x["low"], exon["start"] + x["high"]))
    within = lambda x, exon: turn(x, exon).otherwise(span(x["low"] - exon["start"], x["high"] - exon["start"]))
    read = span(F.col("exon_start"), F.col("exon_end"))

    def part(a: Column) -> Column:
        hull = both(span(rep["start"], rep["end"]), span(a["start"], a["end"]))
        shared = F.coalesce((rep["chrom"] == a["chrom"]) & (hull["low"] < hull["high"]), F.lit(False))
        here = both(onto(read, rep), span(a["start"], a["end"]))
        gone = shared & (here["low"] >= here["high"])
        # on another contig the exons are equal base by base, as far as the alias is long
        copied = both(read, span(zero, a["length"]))
        copied = F.when(copied["low"] < copied["high"], copied).otherwise(span(zero, F.least("bases", a["length"])))
        own = F.when(gone, span(zero, zero)).when(shared, within(here, a)).otherwise(copied)
        bases = own["high"] - own["low"]
        flip = F.coalesce(shared & (rep["strand"] != a["strand"]) & (a["merge_reason"] != "exact_sequence"), F.lit(False))
        return F.struct(
            a["exon_id"].alias("exon_id"), F.when(flip, F.translate("strand", "+-", "-+")).otherwise(F.col("strand")).alias("strand"), own["low"].alias("exon_start"), own["high"].alias("exon_end"),
            bases.alias("bases"), F.when(F.col("bases") > 0, F.bround(F.col("identical") * bases / F.col("bases"), 0).cast("long")).otherwise(zero).alias("identical"),
            a["length"].cast("long").alias("exon_length"), F.when(a["length"] > 0, 100.0 * bases / a["length"]).otherwise(0.0).alias("coverage"), gone.alias("outside"),
        )

    made = F.filter(F.transform("_aliases", part), lambda x: ~x["outside"])
    changed = ["exon_id", "strand", "exon_start", "exon_end", "bases", "identical"]
    own = F.struct(
        *[F.col(c).cast("string" if c in ("exon_id", "strand") else "long").alias(c) for c in changed],
        F.lit(None).cast("long").alias("exon_length"), F.lit(None).cast("double").alias("coverage"), F.lit(False).alias("outside"),
    )
    found = F.when(F.coalesce(rep.isNotNull() & (F.size(made) > 0), F.lit(False)), made).otherwise(F.array(own))
    rest = [c for c in alignments.columns if c not in [*changed, "exon_length", "coverage"]]
    each = met.select(*rest, F.explode(found).alias("_x"))
    return each.select(*rest, *[F.col(f"_x.{c}").alias(c) for c in [*changed, "exon_length", "coverage"]])


def capped_targets(rows: DataFrame, query: str, target: str, score: str, most: int) -> DataFrame:
    """Rows of the `most` best targets of each query, a target being as good as its best row (ties: the smaller name).

    Rows meet as one row a (query, target) before any is ranked.
    """
    best = rows.groupBy(query, target).agg(F.max(score).alias("_best"))
    rank = F.row_number().over(Window.partitionBy(query).orderBy(F.desc("_best"), target))
    kept = best.withColumn("_rank", rank).where(F.col("_rank") <= most).select(query, target)
    return rows.join(kept, [query, target], "left_semi")
