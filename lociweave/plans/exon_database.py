"""The exon database: collapsed exons, anchored sequences, union queries and their aliases, identical paralogs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.operators.intervals import islands
from lociweave.operators.stretches import with_length, with_stretch
from lociweave.storage import dealt, input_width


def collapse_exons(exons: DataFrame) -> DataFrame:
    """One row for each exon id and place: transcripts, numbers and genes in file order, distinct; MANE if any is."""
    keys = ["exon_id_full", "exon_id", "chrom", "start0", "end0", "strand"]
    full = lambda name, bare: F.col(name if name in exons.columns else bare).alias(name)
    cells = F.struct("ord", "tid", full("transcript_id_full", "tid"), "exon_number", "gene_id", full("gene_id_full", "gene_id"), "gene_name", "transcript_type")
    rows = F.array_sort(F.collect_list(cells))
    made = exons.groupBy(*keys).agg(rows.alias("r"), F.bool_or("own_mane").alias("any_mane"), F.bool_or(F.col("transcript_type") == "protein_coding").alias("coding"))
    pairs = F.array_distinct(F.transform("r", lambda x: F.struct(x["transcript_id_full"].alias("tid"), x["exon_number"].alias("n"))))
    return made.select(
        *keys, F.array_distinct("r.tid").alias("transcript_ids"), F.transform(pairs, lambda p: p["n"]).alias("transcript_indices"), F.array_distinct("r.gene_id").alias("gene_ids"),
        F.array_distinct("r.gene_name").alias("gene_names"), "coding", "any_mane",
        F.array_distinct("r.transcript_id_full").alias("transcript_ids_full"), F.array_distinct("r.gene_id_full").alias("gene_ids_full"), pairs.alias("transcript_numbers"),
    )


def anchored(collapsed: DataFrame, genome: DataFrame, target: int = 150, least_unmasked: int = 50) -> DataFrame:
    """Exons with their anchored sequence along the strand, anchors and unmasked bases; genome: (name, seq).

    Exons outside their contig, empty ones and those with fewer than least_unmasked upper-case ACGT are left out.
    """
    met = with_length(collapsed, genome, "chrom").where("start0 >= 0 AND end0 <= contig_length AND start0 < end0")
    low, high = S.anchor_lengths(F.col("start0"), F.col("end0"), F.col("contig_length"), target)
    placed = met.withColumn("_low", low.cast("long")).withColumn("_high", high.cast("long"))
    placed = placed.withColumn("_from", F.col("start0") - F.col("_low")).withColumn("_until", F.col("end0") + F.col("_high"))
    placed, raw = with_stretch(placed, genome, "chrom", "_from", "_until", "_raw"), F.col("_raw")
    minus = F.col("strand") == "-"
    rows = placed.withColumns({
        "sequence": F.when(minus, S.reverse_complement(raw)).otherwise(raw), "left_anchor": F.when(minus, F.col("_high")).otherwise(F.col("_low")),
        "right_anchor": F.when(minus, F.col("_low")).otherwise(F.col("_high")),
    })
    return rows.withColumn("unmasked", S.unmasked_bases(F.col("sequence"))).where(F.col("unmasked") >= least_unmasked).drop("_raw", "_from", "_until", "_low", "_high", "contig_length")


def sequence_groups(exons: DataFrame) -> DataFrame:
    """exons with the representative of their sequence: equal sequence, anchors and length make one group.

    The representative is the longest, then the least masked, then the first by id and place.
    """
    keys = ["sequence", "left_anchor", "right_anchor", "_length"]
    rows = exons.withColumn("_length", F.col("end0") - F.col("start0"))
    best = F.min(F.struct((-F.col("_length")).alias("l"), (-F.col("unmasked")).alias("u"), "exon_id_full", "chrom", "start0", "end0", "strand")).alias("b")
    lead = rows.groupBy(*keys).agg(best).select(*keys, F.col("b.exon_id_full").alias("representative"))
    return rows.join(lead, keys).drop("_length")


def union_queries(exons: DataFrame) -> DataFrame:
    """exons with their search query: (query_id, query_start0, query_end0) and the place of core and anchored interval in it.

    Exons of one contig, strand and gene key whose cores overlap share a query, whose sequence is the reference between its
    outer anchors; others are their own query.  Offsets are along the strand.
    """
    key = S.gene_key(F.col("gene_names"), F.col("gene_ids"))
    rows = exons.withColumn("_key", F.when(F.size(key) > 0, F.array_join(key, ",")).otherwise(F.concat(F.lit("exon "), "exon_id_full")))
    keys = ["chrom", "strand", "_key"]
    numbered = islands(rows, keys, "start0", "end0", touching=False, name="_island")
    low, high = S.query_span(F.col("strand"), F.col("start0"), F.col("end0"), F.col("left_anchor"), F.col("right_anchor"))
    spans = numbered.withColumn("_low", low).withColumn("_high", high)
    union = spans.groupBy(*keys, "_island").agg(
        F.min("_low").alias("query_start0"), F.max("_high").alias("query_end0"), F.min("start0").alias("core_start0"), F.max("end0").alias("core_end0"), F.count("*").alias("members"),
        F.min("exon_id_full").alias("_only"),
    )
    name = S.identifier_of(F.col("chrom"), F.col("strand"), F.col("core_start0").cast("string"), F.col("core_end0").cast("string"), F.col("_key"))
    union = union.withColumn("query_id", F.when(F.col("members") > 1, name).otherwise(F.col("_only"))).drop("_only", "core_start0", "core_end0")
    width, by = input_width(exons), [*keys, "_island"]
    met = dealt(spans, width, by).join(dealt(union, width, by), by)
    minus = F.col("strand") == "-"
    offset = lambda a, b: (F.when(minus, F.col("query_end0") - b).otherwise(a - F.col("query_start0")), F.when(minus, F.col("query_end0") - a).otherwise(b - F.col("query_start0")))
    core, anchor = offset(F.col("start0"), F.col("end0")), offset(F.col("_low"), F.col("_high"))
    return met.withColumns({"core_start": core[0], "core_end": core[1], "anchor_start": anchor[0], "anchor_end": anchor[1]}).drop("_key", "_island", "_low", "_high")


def query_sequences(aliases: DataFrame, genome: DataFrame) -> DataFrame:
    """(query_id, sequence): the reference stretch of every query along its strand."""
    queries = aliases.select("query_id", "chrom", "strand", "query_start0", "query_end0").distinct()
    met = with_stretch(with_length(queries, genome, "chrom"), genome, "chrom", "query_start0", "query_end0", "_raw")
    raw = F.col("_raw")
    return met.select("query_id", F.when(F.col("strand") == "-", S.reverse_complement(raw)).otherwise(raw).alias("sequence"))


def identical_paralogs(exons: DataFrame, mane: DataFrame, genome: DataFrame) -> DataFrame:
    """Gene sets whose MANE transcripts have exactly the same spliced sequences.

    mane: (gene_id, tid).  A transcript counts if its exons lie on one contig and strand in the order of their numbers
    1, 2, ... and its sequence is ACGT only; a gene with a MANE transcript that does not count is in no set.
    Columns: the eight of the report (genes in file order and ';'-joined, the first as representative; transcripts of a gene
    by id and ','-joined, with length and SHA-256 of their sequence), and n_transcripts, the number of different sequences.
    """
    rows = exons.join(mane.select("tid"), "tid", "left_semi").dropDuplicates(["tid", "exon_number", "chrom", "start0", "end0"])
    met = with_stretch(with_length(rows, genome, "chrom"), genome, "chrom", "start0", "end0", "_raw")
    raw = F.col("_raw")
    piece = F.upper(F.when(F.col("strand") == "-", S.reverse_complement(raw)).otherwise(raw))
    made = met.groupBy("tid").agg(
        F.array_sort(F.collect_list(F.struct("exon_number", F.when(F.col("strand") == "-", -F.col("end0")).otherwise(F.col("start0")).alias("at"), piece.alias("s")))).alias("p"),
        F.count_distinct("chrom", "strand").alias("places"),
    )
    whole = F.array_join("p.s", "")
    straight = (F.transform("p", lambda x: x["exon_number"]) == F.sequence(F.lit(1), F.size("p"))) & (F.array_sort("p.at") == F.col("p.at"))
    good = (F.col("places") == 1) & straight & whole.rlike("^[ACGT]+$")
    spliced = made.select("tid", F.when(good, F.sha2(whole, 256)).alias("digest"), F.length(whole).alias("length"))
    sets = mane.join(spliced, "tid", "left").groupBy("gene_id").agg(
        F.array_sort(F.collect_set("digest")).alias("set"), F.count_if(F.col("digest").isNull()).alias("bad"), F.array_sort(F.collect_set(F.struct("tid", "length", "digest"))).alias("t")
    )
    facts = exons.groupBy("gene_id").agg(F.min("ord").alias("ord"), F.min_by("gene_name", "ord").alias("gene_name"))
    good = sets.where("bad = 0 AND size(set) > 0").join(facts, "gene_id")
    members = F.array_sort(F.collect_list(F.struct("ord", "gene_id", "gene_name", "t"))).alias("m")
    groups = good.groupBy("set").agg(members).where("size(m) > 1")
    listed = lambda c: F.array_join(F.transform("m", lambda g: F.array_join(g["t"][c].cast("array<string>"), ",")), ";")
    return groups.select(
        F.col("m")[0]["gene_id"].alias("representative_gene_id"), F.col("m")[0]["gene_name"].alias("representative_gene_name"), F.concat(F.col("m")[0]["gene_name"], F.lit("merged")).alias("merged_gene_name"),
        F.array_join("m.gene_id", ";").alias("gene_ids"), F.array_join("m.gene_name", ";").alias("gene_names"),
        listed("tid").alias("mane_transcript_ids"), listed("length").alias("mane_sequence_lengths"), listed("digest").alias("mane_sequence_sha256"), F.size("set").alias("n_transcripts"),
    )


def fasta_text(sequences: DataFrame, width: int = 80) -> DataFrame:
    """(value): FASTA records of (query_id, sequence), wrapped."""
    wrapped = F.regexp_replace("sequence", f"(.{{{width}}})(?=.)", "$1\n")
    return sequences.select(F.concat(F.lit(">"), F.col("query_id"), F.lit("\n"), wrapped).alias("value"))
