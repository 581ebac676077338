"""Queries that run the written tables, reports and window rules over the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

import lociweave.library_queries  # noqa: F401  whose SQL is used below
from lociweave.functions.scalars import exon_score
from lociweave.plans import annotation as A
from lociweave.plans import audit, search
from lociweave.plans import exon_tables as T
from lociweave.plans.derived import HITS, hits, spans
from lociweave.plans.evidence import with_blocks
from lociweave.queries import _BLOCKS, _SCORE, SQL, query
from lociweave.sources.readers import ALIGNMENT
from lociweave.storage import input_width, read_table, together, written


@query(
    f"""WITH {HITS} SELECT ok, ln, min(qs) OVER (PARTITION BY gene, query_id, strand) AS gene_start0, max(qe) OVER (PARTITION BY gene, query_id, strand) AS gene_end0 FROM hits"""
)
def gene_hulls(spark, sf_dir):
    """The hull of each exon's gene on its contig and strand."""
    exons = hits(spark, sf_dir).select(
        "ok", "ln", "strand", F.col("query_id").alias("chrom"), F.col("qs").alias("start0"), F.col("qe").alias("end0"), F.array("gene").alias("gene_names"), F.array("gene").alias("gene_ids")
    )
    return T.with_gene_bounds(exons).select("ok", "ln", "gene_start0", "gene_end0")


_PLAIN = {
    "query_id": "CAST(query_id AS VARCHAR)", "strand": "strand", "exon_id": "CAST(exon_id AS VARCHAR)", "exon_id_full": "exon_id || '.1'", "cigar": "exon_len || 'M'", "raw_target": "gene",
    "query_start": "CAST(qs AS VARCHAR)", "query_end": "CAST(qe AS VARCHAR)", "exon_length": "CAST(exon_len AS VARCHAR)", "exon_start": "'0'", "exon_end": "CAST(exon_len AS VARCHAR)",
    "aligned_exon_bases": "CAST(exon_len AS VARCHAR)", "identical_bases": "CAST(ident AS VARCHAR)", "NM": "CAST(exon_len - ident AS VARCHAR)",
    "percent_identity": "printf('%.6f', CAST(ident AS DOUBLE) * 100 / exon_len)", "exon_coverage": "printf('%.6f', CAST(100 AS DOUBLE))",
    "AS": "printf('%.6f', CAST(ident AS DOUBLE) / 64)", "evalue": "printf('%.6g', CAST(ident AS DOUBLE) / 3000000000)",
}


@query(f"WITH {HITS} SELECT ok, ln, {', '.join(f'{sql} AS \"{name}\"' for name, sql in _PLAIN.items())} FROM hits")
def alignment_texts(spark, sf_dir):
    """The eighteen text cells of alignments."""
    ident, length = F.col("ident").cast("double"), F.col("exon_len")
    rows = hits(spark, sf_dir).withColumns({
        "exon_id_full": F.concat(F.col("exon_id").cast("string"), F.lit(".1")), "cigar": F.concat(length.cast("string"), F.lit("M")), "raw_target": F.col("gene"), "query_start": F.col("qs"),
        "query_end": F.col("qe"), "exon_length": length, "exon_start": F.lit(0), "exon_end": length, "aligned_exon_bases": length, "identical_bases": F.col("ident"), "NM": length - F.col("ident"),
        "percent_identity": ident * 100 / length, "exon_coverage": F.lit(100.0), "AS": ident / 64, "evalue": ident / 3_000_000_000,
    })
    named = rows.withColumn("query_id", F.concat_ws("\t", F.col("query_id").cast("string"), F.col("ok").cast("string"), F.col("ln").cast("string")))
    cells = T.alignment_rows(named)
    part = lambda i: F.split("query_id", "\t")[i]
    return cells.select(part(1).cast("long").alias("ok"), part(2).cast("long").alias("ln"), part(0).alias("query_id"), *[n for n, _ in ALIGNMENT[1:]])


@query(
    f"""WITH u AS ({SQL['shared_gene_units']}) SELECT unit_id AS merged_gene_id, unit_id AS merged_gene_name, chrom AS reference_contig, '+' AS strand, replace(unit_id, '&', ';') AS member_gene_ids,
  replace(unit_id, '&', ';') AS member_gene_names, shared AS max_pair_shared_exonic_bp FROM u GROUP BY ALL"""
)
def shared_gene_reports(spark, sf_dir):
    """The seven-column report of genes that share more than 14 exonic bases."""
    gene = F.concat(F.lit("g"), F.lpad(F.col("gene").cast("string"), 4, "0"))
    exons = spans(spark, sf_dir).select(
        F.col("loc").alias("chrom"), F.lit("+").alias("strand"), gene.alias("gene_id"), gene.alias("gene_name"), gene.alias("gene_id_full"), F.col("s").alias("start0"), F.col("e").alias("end0"), F.col("s").alias("ord")
    )
    return A.shared_report(A.shared_exon_units(exons, 14, 64))


@query(
    f"""WITH {HITS}, w AS (SELECT DISTINCT gene, query_id AS contig, qs // 5000 * 5000 AS window_start FROM hits),
i AS (SELECT w.*, exon_id % 2 AS exon, strand, qs, qe, ok, ln FROM w JOIN hits h ON h.gene = w.gene AND h.query_id = contig AND qs >= window_start AND qe <= window_start + 5000 WHERE qe > qs),
f AS (SELECT *, CASE WHEN qs < max(qe) OVER (PARTITION BY gene, contig, window_start, exon, strand ORDER BY qs, qe, ok, ln ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM i),
c AS (SELECT gene, contig, window_start, sum(CASE WHEN exon = 0 THEN fresh ELSE 0 END) AS a, sum(CASE WHEN exon = 1 THEN fresh ELSE 0 END) AS b FROM f GROUP BY 1, 2, 3)
SELECT w.gene, w.contig, w.window_start, w.window_start + 5000 AS window_end, coalesce(a = b AND a > 0, false) AS balanced
FROM w LEFT JOIN c ON w.gene = c.gene AND w.contig = c.contig AND w.window_start = c.window_start"""
)
def window_balance(spark, sf_dir):
    """Windows in which the even and the odd exons of a gene have as many copies."""
    rows = hits(spark, sf_dir)
    start = (F.floor(F.col("qs") / 5000) * 5000).cast("long")
    windows = rows.select("gene", F.col("query_id").alias("contig"), start.alias("window_start"), (start + 5000).alias("window_end"))
    windows = together(windows, input_width(rows), windows.columns).distinct()
    found = rows.select("gene", F.col("query_id").alias("contig"), (F.col("exon_id") % 2).cast("long").alias("exon"), "strand", F.col("qs").alias("start"), F.col("qe").alias("end"))
    expected = rows.select("gene").distinct().select("gene", F.explode(F.array(F.lit(0), F.lit(1)).cast("array<bigint>")).alias("exon"))
    return search.window_balance(windows, found, expected, 5000)


_SUPPLIED = f"""{_BLOCKS}, d AS (SELECT DISTINCT query_id, strand, block_id, gene, CAST(exon_id AS VARCHAR) AS exon, qs, qe, exon_len, ident, {_SCORE} AS score FROM n),
h AS (SELECT query_id, strand, block_id, min(qs) AS block_start, max(qe) AS block_end FROM n GROUP BY ALL),
m AS (SELECT *, printf('%s.B%02d', CASE WHEN strand = '-' THEN 'minus' ELSE 'plus' END, row_number() OVER (PARTITION BY query_id, strand ORDER BY block_start, block_end)) AS block FROM h),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id, strand, block_id, gene ORDER BY exon_len DESC, score DESC, exon, qs, qe) AS k,
  max(score) OVER (PARTITION BY query_id, strand, block_id, gene) AS best, count(*) OVER (PARTITION BY query_id, strand, block_id, gene) AS alignments FROM d),
l AS (SELECT query_id, strand, block_id, gene, array_to_string(list_sort(list(DISTINCT exon)), ',') AS exon_ids FROM d GROUP BY ALL)"""


@query(
    f"""{_SUPPLIED} SELECT query_id, strand, block_start, block_end, gene, exon AS supplier_exon, exon_len AS supplier_length, ident AS supplier_identical_bases,
round(score, 6) AS supplier_score, round(best, 6) AS best_score, CAST(alignments AS BIGINT) AS alignments, exon_ids, block
FROM r JOIN m USING (query_id, strand, block_id) JOIN l USING (query_id, strand, block_id, gene) WHERE k = 1"""
)
def audited_blocks(spark, sf_dir):
    """Every block and gene with the exon that scores it, its best score and all exons found there."""
    rows = hits(spark, sf_dir).select(
        "query_id", "strand", "gene", F.col("exon_id").cast("string").alias("exon_id"), F.col("qs").alias("query_start"), F.col("qe").alias("query_end"),
        F.col("exon_len").alias("exon_length"), F.col("ident").alias("identical_bases"), exon_score(F.col("exon_len"), F.col("ident")).alias("_score"),
    )
    placed = written(with_blocks(together(rows, input_width(rows), ["query_id", "strand"]).distinct(), "query_start", "query_end", bin_size=2000), "placed")
    made = audit.block_report(placed, audit.block_names(placed))
    return made.withColumns({"supplier_score": F.round("supplier_score", 6), "best_score": F.round("best_score", 6)})


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS contig, length(text) // 3 AS window_start, length(text) // 3 + length(text) // 2 AS window_end,
substr(text, CAST(length(text) // 3 + 1 AS BIGINT), CAST(length(text) // 2 AS BIGINT)) AS sequence FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL"""
)
def window_stretches(spark, sf_dir):
    """The middle of every text, cut from it by chunks as a window is from its contig."""
    genome = read_table(spark, sf_dir, "documents").where("text IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").cast("string").alias("name"), F.col("text").alias("seq"))
    windows = genome.select(F.col("name").alias("contig"), F.expr("CAST(length(seq) AS BIGINT) div 3").alias("window_start"), F.expr("CAST(length(seq) AS BIGINT) div 3 + CAST(length(seq) AS BIGINT) div 2").alias("window_end"))
    return search.window_sequences(windows, genome).select("contig", "window_start", "window_end", "sequence")
