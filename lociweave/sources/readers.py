"""Readers of annotation, sequence, alignment and report files as DataFrames."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.operators.ranking import gapless_index

ALIGNMENT = [
    ("query_id", "string"), ("percent_identity", "double"), ("query_start", "long"), ("query_end", "long"), ("strand", "string"),
    ("exon_id", "string"), ("exon_id_full", "string"), ("exon_length", "long"), ("exon_start", "long"), ("exon_end", "long"),
    ("aligned_exon_bases", "long"), ("exon_coverage", "double"), ("identical_bases", "long"), ("AS", "double"), ("NM", "long"),
    ("evalue", "double"), ("cigar", "string"), ("raw_target", "string"),
]
LEGACY = ["query_id", "percent_identity", "query_start", "query_end", "strand", "exon_id", "exon_length", "exon_start", "exon_end", "aligned_exon_bases", "AS", "exon_coverage"]
HSP = ["qseqid", "sseqid", "pident", "length", "mismatch", "gaps", "qstart", "qend", "sstart", "send", "evalue", "bitscore", "score", "qlen", "slen", "qseq", "sseq"]


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, ord): text lines, gzip by extension; ord rises with the line within a file, and files follow by name."""
    rows = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    return rows.select("value", F.struct("file_path", "file_block_start", F.monotonically_increasing_id().alias("at")).alias("ord"))


def _cell(i: int) -> Column:
    """Cell i of the split line `c`, null behind its end (filters may run after projections)."""
    return F.get(F.col("c"), F.lit(i))


def gff3(spark: SparkSession, path: str) -> DataFrame:
    """ord, chrom, type, start0, end0, strand, attrs; comments, blank and short lines are left out."""
    cut = lines(spark, path).where("trim(value) <> '' AND NOT startswith(value, '#')").select("ord", F.split("value", "\t").alias("c"))
    return cut.where("size(c) >= 9").select(
        "ord", _cell(0).alias("chrom"), _cell(2).alias("type"), (_cell(3).try_cast("long") - 1).alias("start0"),
        _cell(4).try_cast("long").alias("end0"), _cell(6).alias("strand"), S.attributes(_cell(8)).alias("attrs"),
    )


def _attr(*keys: str) -> Column:
    """The first attribute that is there and not empty, else ''."""
    return F.coalesce(*[F.when(F.try_element_at(F.col("attrs"), F.lit(k)) != "", F.try_element_at(F.col("attrs"), F.lit(k))) for k in keys], F.lit(""))


def annotation_exons(features: DataFrame, numbered: bool = True) -> DataFrame:
    """Exon rows of gff3(): ids with and without version, number, gene, biotype, place, own MANE mark.

    Rows without exon_id, transcript id or exon number, with a number that is none, or without a strand are left out;
    those without a number stay where not `numbered`, as building a database asks for.
    """
    rows = features.where("type = 'exon' AND strand IN ('+', '-')").select(
        "ord", "chrom", "start0", "end0", "strand", _attr("exon_id").alias("exon_id_full"), _attr("transcript_id", "Parent").alias("transcript_id_full"),
        _attr("gene_id").alias("gene_id_full"), _attr("exon_number").try_cast("int").alias("exon_number"), _attr("gene_name").alias("gene_name"),
        _attr("transcript_type", "gene_type").alias("transcript_type"), S.is_mane(F.col("attrs")).alias("own_mane"),
    )
    good = rows.where("exon_id_full <> '' AND transcript_id_full <> '' AND start0 IS NOT NULL AND end0 IS NOT NULL")
    if numbered:
        good = good.where("exon_number IS NOT NULL")
    bare = {n: S.strip_version(F.col(f"{n}_full")) for n in ("exon_id", "gene_id")}
    return good.withColumns(bare | {"tid": S.strip_version(F.col("transcript_id_full"))})


def annotation_transcripts(features: DataFrame) -> DataFrame:
    """tid, ids, gene, biotype, mane from transcript rows; the last row of a transcript gives its facts."""
    rows = features.where("type = 'transcript'").select(
        "ord", _attr("transcript_id", "ID").alias("transcript_id_full"), _attr("gene_id", "Parent").alias("gene_id_full"), _attr("gene_name").alias("gene_name"),
        _attr("transcript_type", "gene_type").alias("transcript_type"), S.is_mane(F.col("attrs")).alias("mane"),
    )
    named = rows.where("transcript_id_full <> ''").withColumn("tid", S.strip_version(F.col("transcript_id_full")))
    last = F.max_by(F.struct("transcript_id_full", "gene_id_full", "gene_name", "transcript_type", "mane"), "ord").alias("t")
    return named.groupBy("tid").agg(last, F.bool_or("mane").alias("any_mane")).select("tid", "t.*", "any_mane")


def fasta(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(name, seq, ordinal): name is the first word of the header, seq all its lines without white space, case kept.

    Files are split at '>' that starts a line, so records of a file are dealt to tasks as Spark deals its blocks; one
    record must fit in memory.  strict: an empty header or record, or text before the first header, is an error.
    """
    raw = spark.read.option("lineSep", "\n>").text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    rows = raw.select(F.struct("file_path", "file_block_start", F.monotonically_increasing_id().alias("at")).alias("ordinal"), F.regexp_replace("value", "^>", "").alias("v"), F.col("value").startswith(">").alias("first"))
    head = F.substring_index(F.regexp_replace("v", "\r", ""), "\n", 1)
    body = F.regexp_replace(F.regexp_replace(F.regexp_replace("v", "\r", ""), "^[^\n]*\n?", ""), "\\s", "")
    out = rows.select(F.regexp_extract(F.trim(head), "^(\\S*)", 1).alias("name"), body.alias("seq"), "ordinal").where("name <> '' OR seq <> ''")
    if strict:
        bad = (F.col("name") == "") | (F.col("seq") == "")
        out = out.withColumn("seq", F.when(bad, F.raise_error(F.lit("FASTA: empty header or record"))).otherwise(F.col("seq")))
    return out


def fasta_lengths(records: DataFrame) -> DataFrame:
    return records.groupBy("name").agg(F.sum(F.length("seq")).alias("length"))


def table(spark: SparkSession, path: str, required: list[str] = (), sep: str = "\t") -> DataFrame:
    """A headed table, all columns text, empty cells ''; missing required columns are an error."""
    rows = spark.read.csv(path, sep=sep, header=True, inferSchema=False, quote="", nullValue="\u0000", emptyValue="")
    missing = [c for c in required if c not in rows.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return rows.na.fill("")


def exon_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct unversioned ids of an eligible-exon list (column exon_id)."""
    rows = table(spark, path, ["exon_id"]).where("trim(exon_id) <> ''")
    found = rows.select(S.strip_version(F.trim("exon_id")).alias("exon_id")).distinct()
    if found.isEmpty():
        raise ValueError(f"{path}: no exon ids")
    return found


def alignments(spark: SparkSession, path: str) -> DataFrame:
    """Exon alignments in any of four layouts: headed, 14 columns or more without header, 10 or more (legacy), or any of
    these cut at white space where the first line has no tab.

    Reversed intervals are swapped, a strand that is not '-' is '+', coverage and identical bases are filled in.
    """
    first = spark.read.text(path).where("trim(value) <> ''").first()
    if first is None:
        return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in ALIGNMENT) + ", at string")
    sep = "\t" if "\t" in first["value"] else None
    cells = re.split(sep or r"\s+", first["value"].strip("\n"))
    names = [n for n, _ in ALIGNMENT]
    headed = "query_id" in cells and "exon_id" in cells
    if headed:
        place = {n: cells.index(n) for n in names if n in cells}
    elif len(cells) >= 14:
        place = {n: i for i, n in enumerate(names) if i < len(cells)}
    elif len(cells) >= 10:
        place = {n: i for i, n in enumerate(LEGACY) if i < len(cells)}
    else:
        raise ValueError(f"{path}: {len(cells)} columns are no alignment layout")
    rows = lines(spark, path).where("trim(value) <> ''").select("ord", F.split(F.trim("value") if sep is None else F.col("value"), sep or "\\s+").alias("c"))
    if headed:
        rows = rows.where(_cell(place["query_id"]) != "query_id")

    def cell(name: str, kind: str) -> Column:
        if name not in place:
            return F.lit("" if kind == "string" else None).cast(kind)
        raw = F.get(F.col("c"), F.lit(place[name]))
        return {"string": F.coalesce(raw, F.lit("")), "double": S.lenient_double(raw), "long": S.lenient_long(raw)}[kind]

    out = rows.select("ord", *[cell(n, t).alias(n) for n, t in ALIGNMENT])
    low, high = F.least("query_start", "query_end"), F.greatest("query_start", "query_end")
    bases = F.when(F.coalesce("aligned_exon_bases", F.lit(0)) > 0, F.col("aligned_exon_bases")).otherwise(F.greatest(F.lit(0), F.col("exon_end") - F.col("exon_start")))
    identical = F.when(F.coalesce("identical_bases", F.lit(0)) > 0, F.col("identical_bases")).otherwise(F.bround(bases * F.col("percent_identity") / 100).cast("long"))
    coverage = F.when(F.coalesce("exon_coverage", F.lit(0.0)) > 0, F.col("exon_coverage")).when(F.col("exon_length") > 0, 100.0 * bases / F.col("exon_length")).otherwise(0.0)
    return out.withColumns({
        "query_start": low, "query_end": high, "strand": F.when(F.col("strand") == "-", "-").otherwise("+"), "aligned_exon_bases": bases,
        "identical_bases": identical, "exon_coverage": coverage, "exon_id": S.strip_version(F.col("exon_id")),
        "exon_id_full": F.when(F.col("exon_id_full") == "", F.col("exon_id")).otherwise(F.col("exon_id_full")),
    })


def paf(spark: SparkSession, path: str) -> DataFrame:
    """query, contig, contig_length, start, end of seed alignments; a line that is none is an error."""
    c = lines(spark, path).where("trim(value) <> ''").select(F.split("value", "\t").alias("c"))
    number = lambda i: F.get(F.col("c"), F.lit(i)).try_cast("long")
    rows = c.select(F.get("c", F.lit(0)).alias("query"), F.get("c", F.lit(5)).alias("contig"), number(6).alias("contig_length"), number(7).alias("start"), number(8).alias("end"), F.size("c").alias("n"))
    good = "coalesce(n >= 12 AND 0 <= start AND start < end AND end <= contig_length, false)"
    return rows.select("query", F.when(F.expr(good), F.col("contig")).otherwise(F.raise_error(F.lit("PAF: malformed line"))).alias("contig"), "contig_length", "start", "end")


def hsps(spark: SparkSession, path: str) -> DataFrame:
    """BLAST tabular rows of 17 columns, or of 15 without the aligned sequences."""
    texts = {"qseqid", "sseqid", "qseq", "sseq"}
    whole = {"length", "mismatch", "gaps", "qstart", "qend", "sstart", "send", "qlen", "slen"}
    rows = lines(spark, path).where("trim(value) <> ''").select("ord", F.split("value", "\t").alias("c"))
    cell = lambda i: F.coalesce(F.get(F.col("c"), F.lit(i)), F.lit(""))
    cast = lambda n, i: cell(i) if n in texts else S.lenient_long(cell(i)) if n in whole else S.lenient_double(cell(i))
    return rows.select("ord", *[cast(n, i).alias(n) for i, n in enumerate(HSP)])


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Mapped SAM rows: query, target, strand, target interval, cigar, AS, NM, and the query interval on its own strand.

    percent_identity is null where there is no PI tag.
    """
    rows = lines(spark, path).where("NOT startswith(value, '@') AND trim(value) <> ''").select(F.split("value", "\t").alias("c"))
    rows = rows.where("size(c) >= 11").select(
        _cell(0).alias("query"), _cell(1).try_cast("int").alias("flag"), _cell(2).alias("target"), (_cell(3).try_cast("long") - 1).alias("start"),
        _cell(5).alias("cigar"), F.slice("c", 12, F.size("c")).alias("tags"),
    ).where("flag & 4 = 0 AND target <> '*' AND cigar <> '*'")
    tag = lambda n: F.regexp_replace(F.get(F.filter("tags", lambda t: t.startswith(f"{n}:")), F.lit(0)), "^[^:]*:[^:]*:", "")
    lead = F.coalesce(F.regexp_extract("cigar", "^([0-9]+)[SH]", 1).try_cast("long"), F.lit(0))
    trail = F.coalesce(F.regexp_extract("cigar", "([0-9]+)[SH]$", 1).try_cast("long"), F.lit(0))
    minus = F.col("flag").bitwiseAND(16) != 0
    used = S.cigar_length(F.col("cigar"), "MI=X")
    skipped = F.when(minus, trail).otherwise(lead)
    return rows.select(
        "query", "target", F.when(minus, "-").otherwise("+").alias("strand"), "start", (F.col("start") + S.cigar_length(F.col("cigar"), "MDN=X")).alias("end"), "cigar",
        skipped.alias("query_start"), (skipped + used).alias("query_end"), S.lenient_double(tag("AS")).alias("AS"), S.lenient_long(tag("NM")).alias("NM"),
        S.lenient_double(tag("EV")).alias("evalue"), tag("PI").try_cast("double").alias("percent_identity"),
    )


def ordinals(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, name) of a one-name-a-line list."""
    rows = lines(spark, path).select(F.trim("value").alias("name"), "ord")
    return gapless_index(rows, [], ["ord"], "ordinal").select("ordinal", "name")


def ordinal_of(subject: Column) -> Column:
    """Number in BL_ORD_ID:n and gnl|BL_ORD_ID|n names, null for others."""
    return F.regexp_extract(subject, "BL_ORD_ID[:|]([0-9]+)", 1).try_cast("long")
