"""Annotation tables: transcripts, exon associations, merged gene units, paralog sets and full-gene models."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociweave.operators.graph import connected_components
from lociweave.operators.intervals import islands, merged, overlap_length, range_join
from lociweave.sources.readers import annotation_exons, annotation_transcripts
from lociweave.storage import written

SHARED_BASES = 100


@dataclass(frozen=True)
class Annotation:
    """exons: rows (tid, exon_number, exon_id, chrom, start0, end0, strand, gene_id, ...) in file order `ord`.
    transcripts: tid, gene and biotype facts, mane, exon_length, model_type.
    """

    exons: DataFrame
    transcripts: DataFrame

    def assoc(self) -> DataFrame:
        """exon_id, tid, exon_number, chrom, start0, end0: for each transcript and number of an exon, its first row."""
        first = F.min_by(F.struct("chrom", "start0", "end0"), "ord").alias("p")
        return self.exons.groupBy("exon_id", "tid", "exon_number").agg(first).select("exon_id", "tid", "exon_number", "p.*")


def spliced_lengths(exons: DataFrame) -> DataFrame:
    """(tid, exon_length): bases over distinct places, so that repeated rows do not count."""
    return exons.select("tid", "chrom", "start0", "end0").distinct().groupBy("tid").agg(F.sum(F.col("end0") - F.col("start0")).alias("exon_length"))


def annotation(features: DataFrame) -> Annotation:
    """From gff3() rows.  A transcript is MANE if its row or any of its exon rows says so.

    Transcripts without a row of their own take their facts from their first exon; empty biotypes and gene names are
    filled from exons.
    """
    exons = annotation_exons(features)
    known = annotation_transcripts(features)
    facts = exons.groupBy("tid").agg(
        F.min_by(F.struct("transcript_id_full", "gene_id_full", "gene_name", "transcript_type"), "ord").alias("e"),
        F.min_by("gene_name", F.when(F.col("gene_name") != "", F.col("ord"))).alias("e_name"),
        F.min_by("transcript_type", F.when(F.col("transcript_type") != "", F.col("ord"))).alias("e_type"),
        F.bool_or("own_mane").alias("e_mane"),
    )
    met = facts.join(known, "tid", "left").join(spliced_lengths(exons), "tid")
    filled = lambda a, b: F.coalesce(F.when(F.col(a) != "", F.col(a)), F.col(b), F.lit(""))
    gene = F.coalesce("gene_id_full", "e.gene_id_full")
    transcripts = met.select(
        "tid", F.coalesce("transcript_id_full", "e.transcript_id_full").alias("transcript_id_full"), gene.alias("gene_id_full"),
        F.regexp_replace(gene, "\\.[0-9]+$", "").alias("gene_id"), filled("gene_name", "e_name").alias("gene_name"), filled("transcript_type", "e_type").alias("transcript_type"),
        (F.coalesce("any_mane", F.lit(False)) | F.col("e_mane")).alias("mane"), "exon_length", F.lit("transcript").alias("model_type"), gene.alias("source_gene_id"),
    )
    return Annotation(exons, transcripts)


def missing_attributes(exons: DataFrame) -> DataFrame:
    """Empty cells of each attribute among exon rows."""
    names = ["gene_id_full", "gene_name", "transcript_type"]
    return exons.agg(*[F.count_if(F.col(n) == "").alias(n) for n in names])


def shared_exon_units(exons: DataFrame, threshold: int = SHARED_BASES, bin_size: int = 100_000) -> DataFrame:
    """(gene_id, chrom, strand, unit_id, unit_name, shared, member_gene_ids, member_gene_names): genes of one strand joined by more than `threshold` shared
    exonic bases, directly or through others; members in the order of (name, id), joined by '&'."""
    named = exons.where("gene_id <> ''")
    keys = ["chrom", "strand", "gene_id"]
    union = merged(named.select(*keys, "start0", "end0"), keys, "start0", "end0", touching=True).drop("island")
    a = union.select("chrom", "strand", F.col("gene_id").alias("a"), F.col("start0").alias("sa"), F.col("end0").alias("ea"))
    b = union.select("chrom", "strand", F.col("gene_id").alias("b"), F.col("start0").alias("sb"), F.col("end0").alias("eb"))
    met = range_join(a, b, ["chrom", "strand"], bin_size, ("sa", "ea"), ("sb", "eb")).where("a < b")
    shared = F.sum(overlap_length(F.col("sa"), F.col("ea"), F.col("sb"), F.col("eb"))).alias("shared")
    pairs = written(met.groupBy("chrom", "strand", "a", "b").agg(shared).where(F.col("shared") > threshold), "pairs")
    node = lambda g: F.concat_ws("\t", "chrom", "strand", g)
    edges = pairs.select(node("a").alias("x"), node("b").alias("y"), "shared")
    found = connected_components(edges, "x", "y")
    names = named.groupBy(*keys).agg(F.min_by("gene_name", "ord").alias("gene_name"), F.min_by("gene_id_full", "ord").alias("gene_id_full"))
    rows = names.withColumn("node", node("gene_id")).join(found, "node")
    most = edges.join(found, edges["x"] == found["node"]).groupBy("component").agg(F.max("shared").alias("shared"))
    member = F.array_sort(F.collect_list(F.struct("gene_name", "gene_id", "gene_id_full"))).alias("m")
    units = rows.groupBy("component").agg(member).join(most, "component")
    shown = F.transform("m", lambda x: F.when(x["gene_name"] != "", x["gene_name"]).otherwise(x["gene_id"]))
    units = units.select(
        "component", F.array_join("m.gene_id", "&").alias("unit_id"), F.array_join(shown, "&").alias("unit_name"), "shared",
        F.array_join("m.gene_id", ";").alias("member_gene_ids"), F.array_join(shown, ";").alias("member_gene_names"),
    )
    return rows.join(units, "component").select(*keys, "unit_id", "unit_name", "shared", "member_gene_ids", "member_gene_names")


def shared_report(units: DataFrame) -> DataFrame:
    """Seven columns, one row a unit: merged id and name, contig, strand, members, most bases that two of them share."""
    return units.select(
        F.col("unit_id").alias("merged_gene_id"), F.col("unit_name").alias("merged_gene_name"), F.col("chrom").alias("reference_contig"), "strand",
        "member_gene_ids", "member_gene_names", F.col("shared").alias("max_pair_shared_exonic_bp"),
    ).distinct().orderBy("reference_contig", "strand", "merged_gene_id")


def with_gene_units(a: Annotation, units: DataFrame) -> Annotation:
    """Genes relabelled to their units, at the units' own loci only; source_gene_id keeps what they were."""
    units = units.select("gene_id", "chrom", "strand", "unit_id", "unit_name")
    exons = a.exons.join(units, ["gene_id", "chrom", "strand"], "left").withColumns(
        {"gene_id": F.coalesce("unit_id", "gene_id"), "gene_id_full": F.coalesce("unit_id", "gene_id_full"), "gene_name": F.coalesce("unit_name", "gene_name")}
    ).drop("unit_id", "unit_name")
    of = a.exons.join(units, ["gene_id", "chrom", "strand"]).groupBy("tid").agg(F.min("unit_id").alias("unit_id"), F.min("unit_name").alias("unit_name"))
    transcripts = a.transcripts.join(of, "tid", "left").withColumns(
        {"gene_id": F.coalesce("unit_id", "gene_id"), "gene_id_full": F.coalesce("unit_id", "gene_id_full"), "gene_name": F.coalesce("unit_name", "gene_name")}
    ).drop("unit_id", "unit_name")
    return Annotation(exons, transcripts)


def with_representatives(a: Annotation, report: DataFrame) -> Annotation:
    """One gene for each set of identical paralogs: (representative_gene_id, merged_gene_name, gene_ids ';'-joined).

    Other members go; the representative takes the merged name.  Sets with a member in a shared unit stay as they are.
    """
    bare = F.transform(F.split("gene_ids", ";"), lambda g: F.regexp_replace(F.trim(g), "\\.[0-9]+$", ""))
    sets = report.select(F.regexp_replace("representative_gene_id", "\\.[0-9]+$", "").alias("lead"), "merged_gene_name", F.explode(bare).alias("member"))
    united = a.exons.where(F.col("gene_id").contains("&")).select(F.explode(F.split("gene_id", "&")).alias("member")).distinct()
    bad = sets.join(united, "member", "left_semi").select("lead").distinct()
    sets = sets.join(bad, "lead", "left_anti")
    gone = sets.where("member <> lead").select(F.col("member").alias("gene_id"))
    names = sets.select(F.col("lead").alias("gene_id"), "merged_gene_name").distinct()

    def apply(df: DataFrame) -> DataFrame:
        kept = df.join(gone, "gene_id", "left_anti").join(names, "gene_id", "left")
        return kept.withColumn("gene_name", F.coalesce("merged_gene_name", "gene_name")).drop("merged_gene_name")

    return Annotation(apply(a.exons), apply(a.transcripts))


def full_gene_models(a: Annotation) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(model exons, model transcripts, report): for each gene, contig and strand the union of its exons as one model.

    Blocks are numbered along the strand.  Model exons keep the exons' own places, so that alignments of any of them
    count for their block.
    """
    keys = ["gene_id", "chrom", "strand"]
    rows = a.exons.where("gene_id <> ''")
    real = rows.join(a.transcripts.where("model_type = 'transcript'").select("tid"), "tid", "left_semi")
    numbered = islands(real, keys, "start0", "end0", touching=False, name="block")
    loci = numbered.groupBy(*keys).agg(F.max("block").alias("blocks"))
    order = Window.partitionBy("gene_id").orderBy("chrom", "strand")
    many = F.count("*").over(Window.partitionBy("gene_id")) > 1
    model = F.concat(F.col("gene_id"), F.lit("_full_gene"), F.when(many, F.concat(F.lit("_"), F.row_number().over(order).cast("string"))).otherwise(""))
    loci = loci.withColumn("model", model)
    number = F.when(F.col("strand") == "-", F.col("blocks") + 1 - F.col("block")).otherwise(F.col("block")).cast("int")
    placed = numbered.join(F.broadcast(loci), keys).withColumn("exon_number", number)
    unique = placed.groupBy("model", *keys, "exon_number", "start0", "end0", "exon_id").agg(
        F.min_by(F.struct("exon_id_full", "gene_id_full", "gene_name", "transcript_type"), "ord").alias("x"), F.min("ord").alias("ord"), F.collect_set("tid").alias("tids"),
        F.collect_set("transcript_type").alias("types"),
    )
    exons = unique.select(
        "ord", "chrom", "start0", "end0", "strand", F.col("x.exon_id_full").alias("exon_id_full"), F.col("model").alias("transcript_id_full"), F.col("x.gene_id_full").alias("gene_id_full"),
        "exon_number", F.col("x.gene_name").alias("gene_name"), F.col("x.transcript_type").alias("transcript_type"), F.lit(False).alias("own_mane"), "exon_id", "gene_id", F.col("model").alias("tid"),
    )
    # blocks are made of the rows where islands numbered them, so that the lists of single exons need not be dealt for a report
    fact = F.min_by(F.struct("exon_id_full", "gene_id_full", "gene_name", "transcript_type"), F.struct("start0", "end0", "exon_id", "ord")).alias("x")
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    blocks = placed.groupBy("model", *keys, "exon_number").agg(
        F.min("start0").alias("start"), F.max("end0").alias("end"), listed("exon_id").alias("source_exon_ids"), listed("tid").alias("source_transcript_ids"),
        fact, F.collect_set("transcript_type").alias("types"),
    )
    types = F.array_distinct(F.flatten(F.collect_list("types")))
    heads = blocks.groupBy("model", *keys).agg(F.sum(F.col("end") - F.col("start")).alias("exon_length"), F.min_by("x", "start").alias("x"), types.alias("types"))
    coding = F.when(F.array_contains("types", "protein_coding"), "protein_coding").otherwise(F.array_min("types"))
    transcripts = heads.select(
        F.col("model").alias("tid"), F.col("model").alias("transcript_id_full"), F.col("x.gene_id_full").alias("gene_id_full"), "gene_id", F.col("x.gene_name").alias("gene_name"),
        coding.alias("transcript_type"), F.lit(False).alias("mane"), "exon_length", F.lit("full_gene").alias("model_type"), F.col("x.gene_id_full").alias("source_gene_id"),
    )
    report = blocks.join(heads.select("model", F.col("x.gene_name").alias("gene_name")), "model").select(
        F.col("model").alias("transcript_id"), F.lit("full_gene").alias("model_type"), "gene_id", "gene_name", F.col("chrom").alias("reference_contig"), "strand", "exon_number",
        "start", "end", "source_exon_ids", "source_transcript_ids",
    )
    return exons, transcripts, report


def with_full_genes(a: Annotation, threshold: int = SHARED_BASES) -> tuple[Annotation, DataFrame]:
    """The annotation with merged units and a full-gene model for every locus, and the models' report."""
    united = with_gene_units(a, shared_exon_units(a.exons, threshold))
    united = replace(united, exons=written(united.exons, "exons"), transcripts=written(united.transcripts, "transcripts"))
    exons, transcripts, report = full_gene_models(united)
    return Annotation(united.exons.unionByName(exons), united.transcripts.unionByName(transcripts)), report
