"""Alignments of queries where candidates place them: ungapped extension of seeds with significance, and gapped realignment in windows."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.functions.scalars import reverse_complement
from lociweave.operators.alignment import Costs, banded_alignments
from lociweave.operators.intervals import islands
from lociweave.operators.stretches import with_stretch

#: Half of the significance formula's constants for ungapped scores of +1 and -2 and even bases; the other follows from the scores.
SEARCH_SIZE = 0.621
ALIGNED = "score long, q_from long, q_to long, t_from long, t_to long, matches long, mismatches long, inserted long, deleted long, cigar string, qseq string, sseq string"


def significance_rate(match: int, mismatch: int) -> float:
    """The positive x of (exp(match * x) + 3 * exp(-mismatch * x)) / 4 = 1, by halving."""
    total = lambda x: (math.exp(match * x) + 3 * math.exp(-mismatch * x)) / 4
    low, high = 1e-6, 1.0
    while total(high) < 1:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if total(middle) < 1 else (low, middle)
    return low


def evalue(score: Column, query_length: Column, target_bases: Column, match: int = 1, mismatch: int = 2, size: float = SEARCH_SIZE) -> Column:
    """Alignments of this score that chance would give for a query in so many target bases."""
    return F.lit(size) * query_length * target_bases * F.exp(-F.lit(significance_rate(match, mismatch)) * score)


def extended(same: np.ndarray, first: int, last: int, match: int, mismatch: int, drop: int) -> tuple[int, int, int]:
    """(start, end, score) of the extension of columns [first, last) of a diagonal, where `same` tells equal columns.

    Either way it goes on until the score is more than `drop` below the best so far, and ends at the first best one.
    """
    value = np.where(same, match, -mismatch)

    def reach(values: np.ndarray) -> tuple[int, int]:
        total = np.cumsum(values)
        top = np.maximum.accumulate(np.concatenate([[0], total]))
        stop = np.flatnonzero(top[1:] - total > drop)
        total = total[: stop[0]] if len(stop) else total
        if not len(total) or total.max() <= 0:
            return 0, 0
        at = int(np.argmax(total))
        return at + 1, int(total[at])

    right, left = reach(value[last:]), reach(value[:first][::-1])
    return first - left[0], last + right[0], int(value[first:last].sum()) + left[1] + right[1]


def _oriented(queries: DataFrame, query_id: str, seq: str) -> DataFrame:
    both = F.array(F.struct(F.lit(False).alias("reverse"), F.upper(seq).alias("s")), F.struct(F.lit(True).alias("reverse"), reverse_complement(F.upper(seq)).alias("s")))
    return queries.select(F.col(query_id), F.explode(both).alias("o")).select(query_id, F.col("o.reverse").alias("reverse"), F.col("o.s").alias("_query"))


def seed_extensions(
    seeds: DataFrame, queries: DataFrame, query_id: str, targets: DataFrame, target_id: str, seq: str, k: int,
    match: int = 1, mismatch: int = 2, drop: int = 20, bin_size: int = 1_000_000,
) -> DataFrame:
    """query_id, query_start, query_end, strand, target_id, target_start, target_end, score, identical, identity and evalue of extended seeds.

    seeds: query_id, query_length, query_at, target_id, target_length, target_at, reverse, of exact stretches of k bases.  Seeds of one diagonal
    that touch are extended once, and equal extensions are one row.  Bases are compared in upper case; only A, C, G and T are equal.  evalue
    is of the query in all bases of `targets`.  Filter by score, identity or evalue: they are plain columns.  Ids must be unique.
    """
    turned = F.when(F.col("reverse"), F.col("query_length") - k - F.col("query_at")).otherwise(F.col("query_at"))
    placed = seeds.select(query_id, target_id, "reverse", "query_length", "target_length", turned.alias("_q"), (F.col("target_at") - turned).alias("_diagonal")).distinct()
    keys = [query_id, target_id, "reverse", "_diagonal"]
    runs = islands(placed.withColumn("_e", F.col("_q") + k), keys, "_q", "_e", touching=True, name="_run", bin_size=bin_size)
    lengths = [F.max(c).alias(c) for c in ("query_length", "target_length")]
    one = runs.groupBy(*keys, "_run").agg(F.min("_q").alias("_from"), F.max("_e").alias("_to"), *lengths).drop("_run")
    low = F.greatest(F.lit(0).cast("long"), F.col("_diagonal"))
    wanted = one.withColumns({"_low": low, "_high": F.least("target_length", F.col("_diagonal") + F.col("query_length"))}).withColumnRenamed("target_length", "contig_length")
    genome = targets.select(F.col(target_id).alias("name"), F.upper(seq).alias("seq"))
    cut = with_stretch(wanted, genome, target_id, "_low", "_high", "_target").join(_oriented(queries, query_id, seq), [query_id, "reverse"])

    @F.arrow_udf("struct<a: long, b: long, score: long, identical: long>")
    def extend(query: pa.Array, target: pa.Array, shift: pa.Array, start: pa.Array, end: pa.Array) -> pa.Array:
        out = []
        for q, t, s, a, b in zip(*[x.to_pylist() for x in (query, target, shift, start, end)], strict=True):
            x, y = np.frombuffer(q.encode("ascii", "replace"), np.uint8)[s : s + len(t)], np.frombuffer(t.encode("ascii", "replace"), np.uint8)
            same = (x == y) & np.isin(x, np.frombuffer(b"ACGT", np.uint8))
            low, high, score = extended(same, a - s, b - s, match, mismatch, drop)
            out.append({"a": low + s, "b": high + s, "score": score, "identical": int(same[low:high].sum())})
        return pa.array(out, pa.struct([(n, pa.int64()) for n in ("a", "b", "score", "identical")]))

    # marked so that a filter on its results is put behind it and does not call it again
    extend = extend.asNondeterministic()
    made = cut.withColumn("_x", extend("_query", "_target", F.col("_low") - F.col("_diagonal"), "_from", "_to"))
    total = targets.agg(F.sum(F.length(seq)).cast("double")).first()[0] or 0.0
    a, b = F.col("_x.a"), F.col("_x.b")
    rows = made.select(
        query_id, F.when(F.col("reverse"), F.col("query_length") - b).otherwise(a).alias("query_start"), F.when(F.col("reverse"), F.col("query_length") - a).otherwise(b).alias("query_end"),
        F.when(F.col("reverse"), "-").otherwise("+").alias("strand"), target_id, (F.col("_diagonal") + a).alias("target_start"), (F.col("_diagonal") + b).alias("target_end"),
        F.col("_x.score").alias("score"), F.col("_x.identical").alias("identical"), (100.0 * F.col("_x.identical") / (b - a)).alias("identity"),
        evalue(F.col("_x.score"), F.col("query_length"), F.lit(total), match, mismatch).alias("evalue"),
    )
    return rows.distinct()


def gapped(query: str, target: str, q_from: int, t_from: int, cigar: str) -> tuple[str, str]:
    """Both rows of an alignment, with '-' for gaps."""
    rows, i, j = ([], []), q_from, t_from
    for n, op in ((int(n), op) for n, op in re.findall(r"(\d+)([=XID])", cigar)):
        rows[0].append("-" * n if op == "D" else query[i : i + n])
        rows[1].append("-" * n if op == "I" else target[j : j + n])
        i, j = i + n * (op != "D"), j + n * (op != "I")
    return "".join(rows[0]), "".join(rows[1])


def aligned(pairs: DataFrame, query: str, target: str, diagonal: str, band: int, costs: Costs = Costs()) -> Column:
    """A struct column (ALIGNED) of the best local alignment of two text columns within `band` of a diagonal (target less query place)."""

    @F.arrow_udf(f"struct<{ALIGNED.replace(' long', ': long').replace(' string', ': string')}>")
    def align(q: pa.Array, t: pa.Array, d: pa.Array) -> pa.Array:
        texts = [[(s or "").upper().encode("ascii", "replace") for s in x.to_pylist()] for x in (q, t)]
        found = banded_alignments(*texts, d.to_pylist(), band, costs)
        made = [(*x, *gapped(a.decode(), b.decode(), x[1], x[3], x[9])) for x, a, b in zip(found, *texts, strict=True)]
        names = [f.split()[0] for f in ALIGNED.split(", ")]
        columns = list(zip(*made, strict=True)) or [()] * len(names)
        return pa.StructArray.from_arrays([pa.array(c, pa.string() if n in ("cigar", "qseq", "sseq") else pa.int64()) for c, n in zip(columns, names, strict=True)], names=names)

    return align.asNondeterministic()(pairs[query], pairs[target], pairs[diagonal])


def realigned(
    chains: DataFrame, queries: DataFrame, query_id: str, targets: DataFrame, target_id: str, seq: str, band: int = 64, costs: Costs = Costs()
) -> DataFrame:
    """Gapped alignments of whole queries in the windows of chains: query_id, query_start, query_end, strand, target_id, target_start, target_end, score,
    matches, mismatches, inserted, deleted, identity, cigar, qseq, sseq.

    chains: as seed_chains gives them.  A window is where the whole query lies if the chain's middle diagonal is carried on, and `band` more on both
    sides, clipped to the contig; the band is around that diagonal.  Places are mapped back to the contig by the window's start.  The CIGAR is along
    the target (I: bases of the query that it lacks, D: its own that the query lacks); qseq and sseq are both rows with gaps, the query as it runs along the
    target.  targets may be a table of chunks (contig, chunk, piece), with contig as target_id.  Equal alignments are one row; chains without an
    alignment are left out.  Ids must be unique.
    """
    reverse = F.col("strand") == "-"
    first = F.when(reverse, F.col("query_length") - F.col("query_end")).otherwise(F.col("query_start"))
    last = F.when(reverse, F.col("query_length") - F.col("query_start")).otherwise(F.col("query_end"))
    middle = F.floor((F.col("target_start") - first + F.col("target_end") - last) / 2).cast("long")
    rows = chains.select(query_id, target_id, "strand", reverse.alias("reverse"), "query_length", F.col("target_length").alias("contig_length"), middle.alias("_diagonal")).distinct()
    zero = F.lit(0).cast("long")
    low = F.greatest(zero, F.col("_diagonal") - band)
    high = F.greatest(low, F.least("contig_length", F.col("_diagonal") + F.col("query_length") + band))
    wanted = rows.withColumns({"_low": low, "_high": high})
    genome = targets if targets.columns == ["contig", "chunk", "piece"] else targets.select(F.col(target_id).alias("name"), F.col(seq).alias("seq"))
    cut = with_stretch(wanted, genome, target_id, "_low", "_high", "_window").join(_oriented(queries, query_id, seq), [query_id, "reverse"])
    cut = cut.withColumn("_shift", F.col("_diagonal") - F.col("_low"))
    made = cut.withColumn("_x", aligned(cut, "_query", "_window", "_shift", band, costs)).where("_x.score > 0")
    a, b = F.col("_x.q_from"), F.col("_x.q_to")
    facts = [F.col(f"_x.{c}").alias(c) for c in ("score", "matches", "mismatches", "inserted", "deleted")]
    columns = F.col("_x.matches") + F.col("_x.mismatches") + F.col("_x.inserted") + F.col("_x.deleted")
    return made.select(
        query_id, F.when(F.col("reverse"), F.col("query_length") - b).otherwise(a).alias("query_start"), F.when(F.col("reverse"), F.col("query_length") - a).otherwise(b).alias("query_end"),
        "strand", target_id, (F.col("_low") + F.col("_x.t_from")).alias("target_start"), (F.col("_low") + F.col("_x.t_to")).alias("target_end"), *facts,
        (100.0 * F.col("_x.matches") / columns).alias("identity"), F.col("_x.cigar").alias("cigar"), F.col("_x.qseq").alias("qseq"), F.col("_x.sseq").alias("sseq"),
    ).distinct()
