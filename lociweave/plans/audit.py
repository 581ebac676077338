"""Why calls came out as they did: blocks and who scores them, exons and their alignments, chains, transcripts.

All tables are reports over what calling made: hits (scored_hits), candidates (chains), calls (call_genes) and the
annotation they were made with; none collects rows to the driver.  write_audit writes them all, with a JSON record a chain.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociweave.operators.ranking import gapless_index
from lociweave.plans.annotation import Annotation
from lociweave.plans.calls import Options
from lociweave.plans.reports import VERSION
from lociweave.sources.manifests import identity, write_json
from lociweave.storage import input_width, together, written

LOCUS = ["query_id", "strand"]
BLOCK = [*LOCUS, "block_start", "block_end"]


def _listed(c: str | Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(c)), ",")


def block_names(hits: DataFrame) -> DataFrame:
    """(query_id, strand, block_start, block_end, block): blocks of a query and strand by place, B01, B02, ..."""
    numbered = gapless_index(hits.select(*BLOCK).distinct(), LOCUS, ["block_start", "block_end"], "_n")
    return numbered.select(*BLOCK, F.format_string("%s.B%02d", F.when(F.col("strand") == "-", "minus").otherwise("plus"), F.col("_n") + 1).alias("block"))


def block_report(hits: DataFrame, names: DataFrame) -> DataFrame:
    """One row a block and gene: the exon that gives its score, the best score of any of its exons, and all of them.

    The supplier is the longest exon, then the best scored, then the first by id and place.  An alignment counts once,
    however many transcripts it serves.
    """
    rows, width = hits.select(*BLOCK, "gene", "exon_id", "query_start", "query_end", "exon_length", "identical_bases", "_score"), input_width(hits)
    rows = together(rows, width, LOCUS).distinct()  # so that groups are made, and meet their names, where they lie
    first = F.struct((-F.col("exon_length")).alias("l"), (-F.col("_score")).alias("s"), "exon_id", "query_start", "query_end")
    best = lambda c, name: F.min_by(c, first).alias(name)
    made = rows.groupBy(*BLOCK, "gene").agg(
        best("exon_id", "supplier_exon"), best("exon_length", "supplier_length"), best("identical_bases", "supplier_identical_bases"), best("_score", "supplier_score"),
        F.max("_score").alias("best_score"), F.count("*").alias("alignments"), _listed("exon_id").alias("exon_ids"),
    )
    return made.join(together(names, width, LOCUS), BLOCK)


def exon_report(a: Annotation, hits: DataFrame, calls: DataFrame, names: DataFrame, eligible: DataFrame | None = None) -> DataFrame:
    """One row for each exon of a gene, each query and strand on which the gene has a hit, and each alignment there.

    status: aligned, `not eligible` or `no alignment`; an exon without an alignment has nulls in its cells.
    selected_transcripts are the calls' models that hold the alignment, null for none; mane_numbers '' where no MANE one has it.
    """
    gene = F.when(F.col("gene_id") != "", F.col("gene_id")).when(F.col("gene_name") != "", F.col("gene_name")).otherwise(F.concat(F.lit("transcript:"), "tid"))
    models = a.transcripts.where("model_type = 'transcript'").select("tid", gene.alias("gene"), "mane")
    exons = a.exons.join(models, "tid").groupBy("gene", "exon_id").agg(
        F.min_by(F.struct("chrom", "start0", "end0", F.col("strand").alias("exon_strand")), "ord").alias("p"), _listed("tid").alias("transcripts"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("mane"), F.col("exon_number")))).cast("array<string>"), ",").alias("mane_numbers"),
    ).select("gene", "exon_id", "p.*", "transcripts", "mane_numbers")
    if eligible is None:
        exons = exons.withColumn("eligible", F.lit(True))
    else:
        marked = eligible.select("exon_id").distinct().withColumn("_e", F.lit(True))
        exons = exons.join(marked, "exon_id", "left").withColumn("eligible", F.coalesce("_e", F.lit(False))).drop("_e")
    place = ["gene", *LOCUS, "exon_id", "query_start", "query_end"]
    found = hits.join(models.select("tid"), "tid", "left_semi").select(
        *place, "exon_length", "identical_bases", "percent_identity", "exon_coverage", "AS", F.col("_score").alias("exon_score"), "block_start", "block_end",
        F.col("score").alias("block_score"), F.col("supplier_exon_id").alias("supplier_exon"),
    ).distinct().join(names, BLOCK).drop("block_start", "block_end")
    held = calls.where("model_type = 'transcript'").select("gene", *LOCUS, "tid", F.explode("hits").alias("h"))
    held = held.groupBy("gene", *LOCUS, F.col("h.exon_id").alias("exon_id"), F.col("h.start").alias("query_start"), F.col("h.end").alias("query_end")).agg(_listed("tid").alias("selected_transcripts"))
    rows = exons.join(found.select("gene", *LOCUS).distinct(), "gene").join(found, ["gene", *LOCUS, "exon_id"], "left").join(held, place, "left")
    status = F.when(F.col("query_start").isNotNull(), "aligned").when(~F.col("eligible"), "not eligible").otherwise("no alignment")
    return rows.withColumns({"status": status, "supplies_score": F.col("supplier_exon") == F.col("exon_id")})


def chain_report(candidates: DataFrame, calls: DataFrame, keys: tuple[str, ...] = ("query_id", "strand", "tid")) -> DataFrame:
    """candidates with outcome: `lost`, `selected whole` or `selected residual`, and what was selected of them.

    Chains of one model hold different blocks, so a call is its candidate's by any of its hits.  keys: with "parent" too
    for transcripts that compete inside one gene.  Adds chain_hits, selected_hits, selected_score and tie_count; these
    are 0 and null for lost ones.
    """
    rows = candidates.withColumn("_chain", F.sha2(F.to_json(F.struct(*keys, "hits.number", "hits.start", "hits.end")), 256))
    hit = lambda df: df.select(*keys, *[c for c in ("_chain", "_weighted", "_held", "_ties") if c in df.columns], F.explode("hits").alias("h")).withColumns(
        {"_at": F.col("h.number"), "_from": F.col("h.start"), "_until": F.col("h.end"), "_exon": F.col("h.exon_id")}
    ).drop("h")
    kept = hit(calls.select(*keys, "hits", F.col("weighted").alias("_weighted"), F.size("hits").alias("_held"), F.col("tie_count").alias("_ties")))
    met = hit(rows).join(kept, [*keys, "_at", "_from", "_until", "_exon"]).groupBy("_chain").agg(
        F.max("_held").alias("_held"), F.max("_weighted").alias("selected_score"), F.max("_ties").alias("tie_count")
    )
    joined = rows.drop("tie_count").join(met, "_chain", "left")
    outcome = F.when(F.col("_held").isNull(), "lost").when(F.col("_held") < F.size("hits"), "selected residual").otherwise("selected whole")
    return joined.withColumns({"outcome": outcome, "chain_hits": F.size("hits"), "selected_hits": F.coalesce("_held", F.lit(0))}).drop("_held", "_chain")


def _by_number(hits: str) -> Column:
    """The hits of a chain by exon number and place, as `h` of structs."""
    return F.array_sort(F.transform(hits, lambda h: F.struct(h["number"].alias("n"), h["start"].alias("s"), h.alias("h"))))


def _scored(ordered: str) -> Column:
    """(h, again) of the hits that are not inserted; again: an earlier one lies in the same block."""
    block = lambda x: F.struct(x["h"]["block_start"], x["h"]["block_end"])
    plain = F.filter(F.col(ordered), lambda x: ~x["h"]["inserted"])
    return F.transform(plain, lambda x, i: F.struct(x["h"].alias("h"), F.exists(F.slice(plain, F.lit(1), i), lambda y: block(y) == block(x)).alias("again")))


def contributions(candidates: DataFrame) -> DataFrame:
    """One row a hit of each candidate, by exon number: what it adds to the chain's raw score.

    A block counts once, with the hit of the smallest number in it; inserted hits count nothing.
    """
    rows = candidates.withColumn("_o", _by_number("hits")).select("gene", "gene_name", "tid", "mane", *LOCUS, "raw", F.explode(_scored("_o")).alias("x"))
    h = lambda c, name: F.col(f"x.h.{c}").alias(name)
    return rows.select(
        "gene", "gene_name", "tid", "mane", *LOCUS, "raw", h("number", "exon_number"), h("exon_id", "exon_id"), h("start", "query_start"), h("end", "query_end"), h("length", "length"),
        h("exon_score", "exon_score"), h("block_start", "block_start"), h("block_end", "block_end"), h("supplier_exon_id", "supplier_exon"), h("supplier_length", "supplier_length"),
        h("score", "block_score"), F.when(F.col("x.again"), 0.0).otherwise(F.col("x.h.score")).alias("contribution"),
    )


def transcript_inventory(a: Annotation, expected: DataFrame, candidates: DataFrame, calls: DataFrame) -> DataFrame:
    """One row a model of the annotation: its exons, those expected, its candidate chains and its selected calls."""
    count = lambda df, name: df.groupBy("tid").agg(F.count("*").alias(name))
    exons = a.exons.groupBy("tid").agg(F.count_distinct("exon_number").alias("exons"))
    rows = a.transcripts.select("tid", "gene_id", "gene_name", "transcript_type", "model_type", "mane", "exon_length").join(exons, "tid", "left")
    rows = rows.join(expected.select("tid", F.size("numbers").alias("expected")), "tid", "left")
    for df, name in ((candidates, "chains"), (calls, "selected")):
        rows = rows.join(count(df, name), "tid", "left")
    return rows.na.fill(0, ["exons", "expected", "chains", "selected"])


def chain_records(report: DataFrame) -> DataFrame:
    """(query_id, strand, tid, record): each row of chain_report as one JSON text, its exons with what they add to the raw score."""
    h = lambda x, c, name: x["h"][c].alias(name)
    exons = F.transform(_scored("_o"), lambda x: F.struct(
        h(x, "number", "exon_number"), h(x, "exon_id", "exon_id"), h(x, "start", "query_start"), h(x, "end", "query_end"), h(x, "length", "length"), h(x, "exon_score", "exon_score"),
        h(x, "block_start", "block_start"), h(x, "block_end", "block_end"), h(x, "supplier_exon_id", "supplier_exon"), h(x, "score", "block_score"),
        F.when(x["again"], 0.0).otherwise(x["h"]["score"]).alias("contribution"),
    ))
    inserted = F.transform(F.filter("_o", lambda x: x["h"]["inserted"]), lambda x: x["h"]["exon_id"])
    facts = F.struct(*[c for c in report.columns if c != "hits"], exons.alias("exons"), inserted.alias("inserted_exons"))
    return report.withColumn("_o", _by_number("hits")).select(*LOCUS, "tid", F.to_json(facts).alias("record"))


def flat(table: DataFrame) -> DataFrame:
    """table for a text file: lists of plain values joined by commas, lists of structs left out."""
    kept = []
    for field in table.schema:
        listed = isinstance(field.dataType, T.ArrayType)
        if listed and not isinstance(field.dataType.elementType, T.StructType):
            kept.append(F.array_join(F.col(field.name).cast("array<string>"), ",").alias(field.name))
        elif not listed:
            kept.append(F.col(field.name))
    return table.select(*kept)


def write_audit(
    spark: SparkSession, out: str, a: Annotation, hits: DataFrame, expected: DataFrame, candidates: DataFrame, calls: DataFrame,
    options: Options = Options(), eligible: DataFrame | None = None, inputs: tuple[str, ...] = (),
) -> dict:
    """Write blocks, exons, chains, contributions and transcripts as tab-separated tables under `out`, chains.jsonl with a
    JSON record a chain, and provenance.json, which is returned: version, options, inputs (path, bytes, time) and rows of each table.
    """
    names = written(block_names(hits), "names")
    report = written(chain_report(candidates, calls), "chains")
    tables = {
        "blocks": block_report(hits, names), "exons": exon_report(a, hits, calls, names, eligible), "chains": report, "contributions": contributions(candidates),
        "transcripts": transcript_inventory(a, expected, candidates, calls),
    }
    counts = {}
    for name, table in tables.items():
        flat(table).write.csv(f"{out}/{name}", sep="\t", header=True, quote="", emptyValue="", mode="overwrite")
        counts[name] = spark.read.csv(f"{out}/{name}", sep="\t", header=True, quote="").count()
    chain_records(report).select("record").write.mode("overwrite").text(f"{out}/chains.jsonl")
    facts = {"version": VERSION, "coordinates": "0-based half-open", "options": asdict(options), "inputs": [identity(spark, p) for p in inputs], "rows": counts}
    write_json(spark, f"{out}/provenance.json", facts)
    return facts
