"""What the exon database is written as (20-column records, 28-column aliases, FASTA, names) and rows of alignment tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lociweave.functions import scalars as S

#: Columns of the exon and alias tables, in order (fixed values).
INFO = (
    "exon_id_full exon_id coordinates chrom start0 end0 strand transcript_id_full transcript_id transcript_index ifmane_transcript gene_id_full gene_id "
    "gene_name ifproteincoding length left_anchor_length right_anchor_length anchored_length unmasked_ACGT"
).split()
ALIASES = (
    "blast_exon_id_full blast_exon_id exon_id_full exon_id coordinates chrom start0 end0 strand length gene_id_full gene_id gene_name transcript_id_full "
    "transcript_id transcript_index ifmane_transcript ifproteincoding left_anchor_length right_anchor_length anchored_length merge_reason query_core_start0 "
    "query_core_end0 query_anchor_start0 query_anchor_end0 gene_start0 gene_end0"
).split()
#: Cells of a FASTA header, in order (fixed values).
HEADER = "exon_id_full coordinates transcript_id_full transcript_index ifmane_transcript gene_id_full gene_name ifproteincoding left_anchor_length right_anchor_length".split()
_LISTS = ["transcript_ids_full", "transcript_ids", "gene_ids_full", "gene_ids", "gene_names"]


def with_gene_bounds(collapsed: DataFrame) -> DataFrame:
    """collapse_exons() rows with gene_start0 and gene_end0: the hull of the gene's exons on one contig and strand.

    Taken before exons are left out for their sequence.  Genes without name and id have the exon's own bounds.
    """
    rows = collapsed.withColumn("_gene", S.gene_key(F.col("gene_names"), F.col("gene_ids")))
    keys = ["_gene", "chrom", "strand"]
    hull = rows.where(F.size("_gene") > 0).groupBy(*keys).agg(F.min("start0").alias("gene_start0"), F.max("end0").alias("gene_end0"))
    met = rows.join(hull, keys, "left").drop("_gene")
    return met.withColumns({"gene_start0": F.coalesce("gene_start0", "start0"), "gene_end0": F.coalesce("gene_end0", "end0")})


def query_records(aliases: DataFrame, sequences: DataFrame) -> DataFrame:
    """One record a query of union_queries(): its exons' lists in order of place, hull, anchors, sequence and `group`.

    Records of one group have equal sequence, anchors and length.  A query has the exons of one gene that overlap.
    """
    member = F.struct("start0", "end0", "exon_id_full", "exon_id", "transcript_numbers", *_LISTS)
    keys = ["query_id", "chrom", "strand", "query_start0", "query_end0"]
    rows = aliases.groupBy(*keys).agg(
        F.array_sort(F.collect_list(member)).alias("m"), F.min("start0").alias("start0"), F.max("end0").alias("end0"),
        F.bool_or("any_mane").alias("any_mane"), F.bool_or("coding").alias("coding"),
    ).join(sequences, "query_id")
    numbers = F.transform(F.array_distinct(F.flatten(F.col("m.transcript_numbers"))), lambda p: p["n"])
    one, minus = F.size("m") == 1, F.col("strand") == "-"
    before, behind = F.col("start0") - F.col("query_start0"), F.col("query_end0") - F.col("end0")
    made = rows.select(
        *keys, "start0", "end0", "any_mane", "coding", "sequence", F.col("query_id").alias("exon_id_full"),
        F.when(one, F.col("m")[0]["exon_id"]).otherwise(F.col("query_id")).alias("exon_id"),
        *[F.array_distinct(F.flatten(F.col(f"m.{c}"))).alias(c) for c in _LISTS], numbers.alias("transcript_indices"),
        F.when(minus, behind).otherwise(before).alias("left_anchor"), F.when(minus, before).otherwise(behind).alias("right_anchor"),
    )
    length = F.col("end0") - F.col("start0")
    group = F.sha2(F.concat_ws("|", "sequence", F.col("left_anchor").cast("string"), F.col("right_anchor").cast("string"), length.cast("string")), 256)
    return made.withColumns({"unmasked": S.unmasked_bases(F.col("sequence")), "group": group})


def representatives(records: DataFrame) -> DataFrame:
    """The record that stands for each group: least masked, then first by id and place."""
    order = F.struct((-F.col("unmasked")).alias("u"), "exon_id_full", "chrom", "start0", "end0", "strand")
    return records.groupBy("group").agg(F.min_by(F.struct(*[c for c in records.columns if c != "group"]), order).alias("r")).select("group", "r.*")


def _cells(length: Column, sequence_length: Column) -> dict[str, Column]:
    listed = lambda c: F.array_join(F.col(c).cast("array<string>"), ",", "")
    flag = lambda c: F.when(F.col(c), "1").otherwise("0")
    return {
        "coordinates": F.concat("chrom", F.lit(":"), F.col("start0").cast("string"), F.lit("-"), F.col("end0").cast("string"), "strand"),
        "transcript_id_full": listed("transcript_ids_full"), "transcript_id": listed("transcript_ids"), "transcript_index": listed("transcript_indices"),
        "ifmane_transcript": flag("any_mane"), "gene_id_full": listed("gene_ids_full"), "gene_id": listed("gene_ids"), "gene_name": listed("gene_names"),
        "ifproteincoding": flag("coding"), "length": length, "left_anchor_length": F.col("left_anchor"), "right_anchor_length": F.col("right_anchor"),
        "anchored_length": sequence_length,
    }


def info_rows(leads: DataFrame) -> DataFrame:
    """Twenty columns and the sequence, one row a representative, in order of place."""
    cells = _cells(F.col("end0") - F.col("start0"), F.length("sequence")) | {"unmasked_ACGT": F.col("unmasked")}
    return leads.withColumns(cells).select(*INFO, "sequence").orderBy("chrom", "start0", "end0", "strand", "exon_id_full")


def alias_rows(aliases: DataFrame, records: DataFrame, leads: DataFrame) -> DataFrame:
    """Twenty-eight columns, one row an exon: the record that stands for it, why, its place in the query, its gene's hull.

    aliases: union_queries() of exons with gene bounds.
    """
    lead = leads.select("group", F.col("exon_id_full").alias("blast_exon_id_full"), F.col("exon_id").alias("blast_exon_id"), F.col("query_id").alias("_lead"), F.struct("chrom", "start0", "end0", "strand").alias("_place"))
    of = records.select("query_id", "group").join(lead, "group")
    own = (F.col("query_id") == F.col("_lead")) & (F.struct("chrom", "start0", "end0", "strand") == F.col("_place"))
    reason = F.when(F.col("members") > 1, "same_gene_overlap").when(own, "representative").otherwise("exact_sequence")
    cells = _cells(F.col("end0") - F.col("start0"), F.length("sequence")) | {
        "merge_reason": reason, "query_core_start0": F.col("core_start"), "query_core_end0": F.col("core_end"),
        "query_anchor_start0": F.col("anchor_start"), "query_anchor_end0": F.col("anchor_end"),
    }
    return aliases.join(of, "query_id").withColumns(cells).select(*ALIASES).orderBy("blast_exon_id_full", "chrom", "start0", "end0", "exon_id_full")


def fasta_records(info: DataFrame, width: int = 80) -> DataFrame:
    """(value): a FASTA record a row, the header's ten cells parted by tabs, the sequence wrapped."""
    wrapped = F.regexp_replace("sequence", f"(.{{{width}}})(?=.)", "$1\n")
    return info.select(F.concat(F.lit(">"), F.concat_ws("\t", *[F.col(c).cast("string") for c in HEADER]), F.lit("\n"), wrapped).alias("value"))


def write_exon_tables(info: DataFrame, aliases: DataFrame, folder: str) -> None:
    """exon_info, exon_aliases, exons.fa and exons.seq under `folder`; names stand in the order of the FASTA records."""
    table = {"sep": "\t", "header": True, "quote": "", "emptyValue": "", "mode": "overwrite"}
    info.drop("sequence").write.csv(f"{folder}/exon_info", **table)
    aliases.write.csv(f"{folder}/exon_aliases", **table)
    fasta_records(info).write.text(f"{folder}/exons.fa")
    info.select(F.regexp_extract("exon_id_full", "^(\\S*)", 1)).write.text(f"{folder}/exons.seq")


@F.pandas_udf(StringType())
def six_places(x: pd.Series) -> pd.Series:
    return x.map(lambda v: None if pd.isna(v) else f"{v:.6f}")


@F.pandas_udf(StringType())
def six_digits(x: pd.Series) -> pd.Series:
    return x.map(lambda v: None if pd.isna(v) else f"{v:.6g}")


def alignment_rows(alignments: DataFrame, legacy: bool = False) -> DataFrame:
    """Text cells of alignments() rows: 18 columns, or the 13 of the old layout, whose last repeats AS.

    Fractions have six places, e-values six digits, rounded as C does (Spark's format_string rounds halves up).
    """
    places = {c: six_places(F.col(c).cast("double")) for c in ("percent_identity", "exon_coverage", "AS")}
    names = ["query_id", "percent_identity", "query_start", "query_end", "strand", "exon_id"]
    if legacy:
        names += ["exon_length", "exon_start", "exon_end", "aligned_exon_bases", "AS", "exon_coverage"]
    else:
        names += ["exon_id_full", "exon_length", "exon_start", "exon_end", "aligned_exon_bases", "exon_coverage", "identical_bases", "AS", "NM", "evalue", "cigar", "raw_target"]
        places["evalue"] = six_digits(F.col("evalue").cast("double"))
    made = alignments.select(*[places.get(c, F.col(c).cast("string")).alias(c) for c in names])
    return made.withColumn("AS_again", F.col("AS")) if legacy else made


def sam_alignments(rows: DataFrame, exons: DataFrame) -> DataFrame:
    """sam() rows, whose targets are exons, as alignments() rows; exons: (exon_id_full, exon_id, length), ids unique.

    A target is found by its full id, else by its id without version; one that is not found has the length it reaches.
    Identity is the PI tag, else the share of alignment columns that NM leaves.
    """
    name = F.regexp_extract("target", "^(\\S*)", 1)
    by_full = exons.select(F.col("exon_id_full").alias("_f"), F.struct("exon_id_full", "exon_id", "length").alias("_a"))
    by_bare = exons.groupBy(F.col("exon_id").alias("_b")).agg(F.min(F.struct("exon_id_full", "exon_id", "length")).alias("_c"))
    met = rows.withColumn("_t", name).join(by_full, F.col("_t") == F.col("_f"), "left").join(by_bare, S.strip_version(F.col("_t")) == F.col("_b"), "left")
    meta = F.coalesce("_a", "_c")
    bases, columns = S.cigar_length(F.col("cigar"), "MDN=X"), S.cigar_length(F.col("cigar"), "MID=X")
    identity = F.coalesce("percent_identity", F.when(columns > 0, F.greatest(F.lit(0.0), 100.0 * (columns - F.coalesce("NM", F.lit(0))) / columns)).otherwise(0.0))
    length = F.when(meta["length"] > 0, meta["length"]).otherwise(F.greatest("end", bases))
    return met.select(
        F.col("query").alias("query_id"), identity.alias("percent_identity"), "query_start", "query_end", "strand",
        F.coalesce(meta["exon_id"], S.strip_version(F.col("_t"))).alias("exon_id"), F.coalesce(meta["exon_id_full"], F.col("_t")).alias("exon_id_full"),
        length.alias("exon_length"), F.col("start").alias("exon_start"), F.col("end").alias("exon_end"), bases.alias("aligned_exon_bases"),
        F.when(length > 0, 100.0 * bases / length).otherwise(0.0).alias("exon_coverage"), F.bround(identity / 100 * columns).cast("long").alias("identical_bases"),
        F.coalesce("AS", F.lit(0.0)).alias("AS"), F.coalesce("NM", F.lit(0)).cast("long").alias("NM"), F.coalesce("evalue", F.lit(0.0)).alias("evalue"),
        "cigar", F.col("target").alias("raw_target"),
    )
