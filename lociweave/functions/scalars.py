"""Scalar rules of the engine as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC nucleotide codes and their complements (fixed values), upper and lower case.
IUPAC = "ACGTURYSWKMBDHVNacgturyswkmbdhvn"
COMPLEMENT = "TGCAAYRSWMKVHDBNtgcaayrswmkvhdbn"


def strip_version(identifier: Column) -> Column:
    return F.regexp_replace(identifier, "\\.[0-9]+$", "")


def lenient_double(text: Column, default: float = 0.0) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(default))


def lenient_long(text: Column, default: int = 0) -> Column:
    """Whole part of a number as text, truncated toward zero; anything else is the default."""
    return F.coalesce(text.try_cast("double").try_cast("long"), F.lit(default))


def attributes(text: Column) -> Column:
    """GFF3 `k=v;` or GTF `k "v";` attributes as a map; the later of two equal keys wins."""
    pairs = F.filter(F.transform(F.split(text, ";"), lambda p: F.trim(p)), lambda p: p != "")
    cut = F.transform(
        pairs,
        lambda p: F.struct(
            F.trim(F.when(p.contains("="), F.substring_index(p, "=", 1)).otherwise(F.substring_index(p, " ", 1))).alias("key"),
            F.btrim(F.trim(F.when(p.contains("="), p.substr(F.position(F.lit("="), p) + 1, F.length(p))).otherwise(p.substr(F.length(F.substring_index(p, " ", 1)) + 2, F.length(p)))), F.lit('"')).alias("value"),
        ),
    )
    last = F.filter(cut, lambda x, i: ~F.exists(F.slice(cut, i + 2, F.size(cut)), lambda y: y["key"] == x["key"]))
    return F.map_from_entries(last)


def is_mane(attrs: Column) -> Column:
    """MANE anywhere in any key or value, in any case."""
    return F.exists(F.map_entries(attrs), lambda e: F.upper(e["key"]).contains("MANE") | F.upper(e["value"]).contains("MANE"))


def exon_score(length: Column, identical: Column) -> Column:
    """100 * (L - 4 * mismatches) / L with the identical bases held within [0, L]; 0 for L <= 0."""
    kept = F.least(F.greatest(identical, F.lit(0)), length)
    return F.when(length <= 0, F.lit(0.0)).otherwise(100.0 * (length - 4.0 * (length - kept)) / length)


def weighted_score(raw: Column, coding: Column, complete: Column, mane: Column, coding_x: float = 10.0, complete_x: float = 2.0, mane_x: float = 1.0) -> Column:
    times = lambda flag, x: F.when(flag, F.lit(x)).otherwise(F.lit(1.0))
    return raw * times(coding, coding_x) * times(complete, complete_x) * times(mane, mane_x)


def oriented(strand: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """The interval as seen along its strand: itself, or mirrored on '-'."""
    minus = strand == "-"
    return F.when(minus, -end).otherwise(start), F.when(minus, -start).otherwise(end)


def reverse_complement(sequence: Column) -> Column:
    return F.reverse(F.translate(sequence, IUPAC, COMPLEMENT))


def unmasked_bases(sequence: Column) -> Column:
    return F.length(F.regexp_replace(sequence, "[^ACGT]", ""))


def anchor_lengths(start: Column, end: Column, contig_length: Column, target: int = 150) -> tuple[Column, Column]:
    """Bases to add left and right of a short exon so that it has `target` bases, within the contig."""
    want = F.greatest(F.lit(0), F.floor((target - (end - start) + 1) / 2))
    return F.least(want, start), F.least(want, contig_length - end)


def query_span(strand: Column, start: Column, end: Column, left: Column, right: Column) -> tuple[Column, Column]:
    """Genomic span of an anchored query; on '-' the left anchor lies behind the exon."""
    minus = strand == "-"
    return start - F.when(minus, right).otherwise(left), end + F.when(minus, left).otherwise(right)


def gap_limit(span: Column) -> Column:
    return F.floor(3 * span / 2).cast("long")


def window_padding(span: Column) -> Column:
    return F.floor((3 * span + 1) / 2).cast("long")


def gene_key(names: Column, ids: Column) -> Column:
    """Sorted distinct names, or ids where there are no names; blank ones and '.' are none."""
    tidy = lambda a: F.array_sort(F.array_distinct(F.filter(F.transform(a, lambda x: F.trim(x)), lambda x: x.isNotNull() & ~x.isin("", "."))))
    return F.when(F.size(tidy(names)) > 0, tidy(names)).otherwise(tidy(ids))


def reciprocal_overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    shared = F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start))
    longest = F.greatest(a_end - a_start, b_end - b_start)
    return F.when(longest > 0, shared / longest).otherwise(0.0)


def bed_score(fractions: Column) -> Column:
    """1000 times the largest fraction, rounded half to even, held within [0, 1000]."""
    return F.least(F.lit(1000), F.greatest(F.lit(0), F.bround(1000 * F.coalesce(F.array_max(fractions), F.lit(0.0))).cast("int")))


def cigar_length(cigar: Column, operations: str) -> Column:
    """Summed lengths of the operations named."""
    parts = F.regexp_extract_all(cigar, F.lit(f"([0-9]+)[{operations}]"), 1)
    return F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def query_location(name: Column) -> tuple[Column, Column]:
    """(contig, offset) of names like contig_start_end; other names are themselves at 0."""
    suffix = "^(.+)_([0-9]+)_([0-9]+)$"
    named = name.rlike(suffix)
    return F.when(named, F.regexp_extract(name, suffix, 1)).otherwise(name), F.when(named, F.regexp_extract(name, suffix, 2).cast("long")).otherwise(F.lit(0).cast("long"))


def in_region(query_id: Column, start: Column, end: Column, chrom: str, low: int, high: int) -> Column:
    """Half-open overlap with a region whose chromosome is the query's name or part of it."""
    return query_id.contains(chrom) & (start < high) & (end > low)


def parse_region(text: str) -> tuple[str, int, int]:
    """chrom:start-end with optional commas and a /rc suffix; bounds in either order."""
    chrom, _, span = text.replace(",", "").removesuffix("/rc").rpartition(":")
    a, _, b = span.partition("-")
    low, high = sorted((int(a), int(b)))
    return chrom, low, high


def identifier_of(*parts: Column) -> Column:
    """A stable name for a union query: LWQ_ and a digest of its parts."""
    return F.concat(F.lit("LWQ_"), F.sha2(F.concat_ws("|", *parts), 256))
