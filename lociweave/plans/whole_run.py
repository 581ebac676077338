"""From an annotation, its genome and sample genomes to call tables, in one call.

The annotation's exons become search queries (exon_database), minimisers seed them on all samples at once, chains along diagonals say where they may lie,
a second search with shorter words looks for all exons of a gene around those that were found, gapped realignment in those windows gives alignments, which are cut to exons and called.  Samples are a column of the contigs' names, so that one plan
serves any number of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.operators.stretches import chunks
from lociweave.plans import annotation as A
from lociweave.plans import calls as C
from lociweave.plans import reports
from lociweave.plans.evidence import select_alignments
from lociweave.plans.exon_database import anchored, collapse_exons, query_sequences, union_queries
from lociweave.plans.realign import evalue, realigned
from lociweave.plans.search import projected, seed_windows, window_sequences
from lociweave.plans.seeding import minimiser_seeds, seed_chains, seeds_in_windows
from lociweave.sources import readers
from lociweave.sources.fasta_ranges import fasta_chunks
from lociweave.storage import written

#: Between a sample's name and its contig's, in neither of them.
MARK = "\t"


@dataclass(frozen=True)
class Search:
    """Minimisers (k, w, most), chains (max_gap, drift, least_anchors, least_score), realignment (band) and the least that an alignment must have.

    local_k, local_w, local_anchors and local_score are for the second search, in the windows of genes that the first has found; local_k of 0 leaves it out.
    """

    k: int = 15
    w: int = 5
    most: int = 1000
    max_gap: int = 1000
    drift: int = 500
    least_anchors: int = 3
    least_score: int = 40
    band: int = 64
    local_k: int = 11
    local_w: int = 3
    local_anchors: int = 2
    local_score: int = 22
    least_as: float = 50.0
    least_identity: float = 95.0
    least_coverage: float = 90.0

    def __post_init__(self):
        checks = {
            "k is 1 to 31, local_k 0 to 31": 1 <= self.k <= 31 and 0 <= self.local_k <= 31,
            "w, most, max_gap and least anchors are at least 1": min(self.w, self.local_w, self.most, self.max_gap, self.least_anchors, self.local_anchors) >= 1,
            "drift, least scores and band are not below 0": min(self.drift, self.least_score, self.local_score, self.band) >= 0,
            "identity and coverage are 0 to 100": all(0 <= x <= 100 for x in (self.least_identity, self.least_coverage)),
        }
        if failed := [rule for rule, held in checks.items() if not held]:
            raise ValueError("; ".join(failed))


def genome_of(spark: SparkSession, path: str) -> DataFrame:
    """(contig, chunk, piece) of a FASTA file, by byte ranges where it is not compressed."""
    return chunks(readers.fasta(spark, path)) if path.endswith(".gz") else fasta_chunks(spark, path)[0]


def sample_genomes(spark: SparkSession, samples: DataFrame) -> DataFrame:
    """(contig, chunk, piece) of all samples (name, fasta), contigs named sample, MARK, contig.  samples is a short list."""
    parts = [genome_of(spark, r["fasta"]).withColumn("contig", F.concat(F.lit(r["name"] + MARK), "contig")) for r in samples.select("name", "fasta").collect()]
    if not parts:
        raise ValueError("no samples")
    return reduce(lambda a, b: a.unionByName(b), parts)


def exon_alignments(exons: DataFrame, genome: DataFrame, targets: DataFrame, search: Search = Search()) -> DataFrame:
    """Alignments (readers.ALIGNMENT) of annotated exons on targets (contig, chunk, piece); genome: the annotation's own (contig, chunk, piece)."""
    aliases = written(union_queries(anchored(collapse_exons(exons), genome)), "aliases")
    queries = written(query_sequences(aliases, genome), "queries")
    seeds, _ = minimiser_seeds(queries.withColumnRenamed("sequence", "piece"), "query_id", targets, "contig", "piece", search.k, search.w, search.most)
    chained = written(seed_chains(seeds, "query_id", "contig", search.k, search.max_gap, search.drift, search.least_anchors, search.least_score), "chains")
    if search.local_k:
        chained = written(chained.unionByName(_chains_in_windows(chained, aliases, queries, targets, search)), "chains")
    found = realigned(chained, queries.withColumnRenamed("sequence", "piece"), "query_id", targets, "contig", "piece", search.band)
    lengths = queries.select(F.col("query_id").alias("_q"), F.length("sequence").cast("long").alias("qlen"))
    total = targets.agg(F.sum(F.length("piece")).cast("double")).first()[0] or 0.0
    met = written(found.join(lengths, F.col("query_id") == F.col("_q")), "found")
    minus = F.col("strand") == "-"
    hsps = met.select(
        F.col("query_id").alias("qseqid"), F.col("contig").alias("sseqid"), F.when(minus, F.col("query_end")).otherwise(F.col("query_start") + 1).alias("qstart"),
        F.when(minus, F.col("query_start") + 1).otherwise(F.col("query_end")).alias("qend"), (F.col("target_start") + 1).alias("sstart"), F.col("target_end").alias("send"),
        "qseq", "sseq", F.col("score").cast("double").alias("score"), evalue(F.col("score"), F.col("qlen"), F.lit(total)).alias("evalue"), F.monotonically_increasing_id().alias("ord"),
    )
    places = aliases.select("query_id", "exon_id", "core_start", "core_end", "anchor_start", "anchor_end").distinct()
    cut = projected(hsps, places)
    return cut.select(
        "query_id", F.col("identity").alias("percent_identity"), F.col("target_start").alias("query_start"), F.col("target_end").alias("query_end"), "strand", "exon_id",
        F.col("exon_id").alias("exon_id_full"), "exon_length", "exon_start", "exon_end", F.col("bases").alias("aligned_exon_bases"), F.col("coverage").alias("exon_coverage"),
        F.col("identical").alias("identical_bases"), "AS", F.col("NM").cast("double").alias("NM"), "evalue", "cigar", F.col("query_id").alias("raw_target"),
    )


def _chains_in_windows(chained: DataFrame, aliases: DataFrame, queries: DataFrame, targets: DataFrame, search: Search) -> DataFrame:
    """Chains of shorter words of all queries of a gene in the windows around those that were found."""
    owners = aliases.select("query_id", F.explode("gene_ids").alias("gene"), "start0", "end0")
    genes = owners.groupBy("gene").agg((F.max("end0") - F.min("start0")).alias("span"))
    query_genes = owners.select("query_id", "gene").distinct()
    seeds = chained.select(F.col("query_id").alias("query"), "contig", F.col("target_length").alias("contig_length"), F.col("target_start").alias("start"), F.col("target_end").alias("end"))
    windows = seed_windows(seeds, genes, query_genes.withColumnRenamed("query_id", "query"))
    cut = written(window_sequences(windows, targets), "windows")
    lengths = chained.select("contig", "target_length").distinct()
    cut = cut.join(lengths, "contig").withColumnRenamed("target_length", "contig_length")
    near = seeds_in_windows(queries, query_genes, cut, search.local_k, search.local_w)
    return seed_chains(near, "query_id", "contig", search.local_k, search.max_gap, search.drift, search.local_anchors, search.local_score)


def annotate_samples(
    spark: SparkSession, annotation: str, genome: str, samples: DataFrame, out: str | None = None, options: C.Options = C.Options(), search: Search = Search()
) -> DataFrame:
    """The call table (reports.COLUMNS, row_order, is_fragment) of all samples, with `sample` and the sample's own contig names.

    annotation: a GFF3 file of the genome (FASTA); samples: (name, fasta).  With `out`, main and fragment tables are written to a folder a sample
    under out/calls and out/fragments too.  Alignments below the least score, identity or coverage are left out, as are exons of the annotation
    that cannot be searched (see anchored).
    """
    a = A.annotation(readers.gff3(spark, annotation))
    rows = exon_alignments(a.exons, genome_of(spark, genome), sample_genomes(spark, samples), search)
    kept = written(select_alignments(rows, search.least_as, search.least_identity, search.least_coverage).where("rejected IS NULL").drop("rejected"), "alignments")
    calls, _ = C.call_genes(kept, a, options)
    table = written(reports.call_table(calls), "calls")
    named = table.withColumns({"sample": F.substring_index("query_contig", MARK, 1), "query_contig": F.substring_index("query_contig", MARK, -1)})
    if out:
        for folder, which in (("calls", ~F.col("is_fragment")), ("fragments", F.col("is_fragment"))):
            part = named.where(which).withColumnRenamed("sample", "_sample").drop("is_fragment")
            reports.write_by_sample(part, samples.select("name"), "_sample", f"{out}/{folder}")
    return named
