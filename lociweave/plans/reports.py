"""Output tables: the 44-column call table, overlap groups, the legacy table and BED."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lociweave.functions import scalars as S
from lociweave.operators.intervals import range_join
from lociweave.plans.exon_tables import six_places

VERSION = "3"
#: Columns of the call table, in order (fixed values).
COLUMNS = (
    "GENE_index transcript_id gene_id gene_name transcript_type ifmane_transcript weighted_score raw_exon_score total_aligned_bases mean_identity "
    "mean_exon_coverage expected_exons found_exons missing_exons fraction_expected_found found_exon_numbers query_id query_contig query_start query_end "
    "strand exon_query_coordinates exon_reference_coordinates exon_ids exon_coverages exon_identities alignment_AS call_status tie_group_id tie_count "
    "assignment_status pipeline_version merged_interval_coordinates merged_interval_gene_scores merged_interval_score_exon_ids "
    "merged_interval_score_exon_lengths transcript_exon_length model_type inserted_exons insertion_penalty inserted_exon_numbers "
    "inserted_exon_query_coordinates inserted_query_blocks insertion_run_unique_exons"
).split()
#: Columns in which tied alternatives always stand side by side (fixed values).
PAIRED = (
    "transcript_id gene_id gene_name found_exon_numbers total_aligned_bases mean_identity mean_exon_coverage exon_query_coordinates "
    "exon_reference_coordinates exon_ids exon_coverages exon_identities alignment_AS merged_interval_coordinates merged_interval_gene_scores "
    "merged_interval_score_exon_ids merged_interval_score_exon_lengths model_type inserted_exon_numbers inserted_exon_query_coordinates "
    "insertion_run_unique_exons"
).split()
BED_EXTRA = (
    "haplotype gene_id gene_name transcript_id transcript_type ifmane_transcript call_status expected_exons found_exons missing_exons "
    "fraction_expected_found mean_identity mean_exon_coverage found_exon_numbers exon_ids exon_query_coordinates exon_reference_coordinates exon_coverages "
    "exon_identities tie_group_id tie_count assignment_status pipeline_version merged_interval_coordinates merged_interval_gene_scores model_type "
    "GENE_index inserted_exons insertion_penalty inserted_query_blocks insertion_run_unique_exons"
).split()


def _float_sum(values: Column) -> Column:
    """The compensated sum that Python's sum() makes of floats, so that rounded cells are those of a plain program."""
    def add(a: Column, x: Column) -> Column:
        total = a["s"] + x
        lost = F.when(F.abs(a["s"]) >= F.abs(x), (a["s"] - total) + x).otherwise((x - total) + a["s"])
        return F.struct(total.alias("s"), (a["c"] + lost).alias("c"))

    return F.aggregate(values, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c")), add, lambda a: a["s"] + a["c"])


@F.pandas_udf(StringType())
def _listed_places(x: pd.Series) -> pd.Series:
    return x.map(lambda v: None if v is None else ",".join([f"{i:.3f}" for i in v]))


@F.pandas_udf(StringType())
def _listed_six(x: pd.Series) -> pd.Series:
    return x.map(lambda v: None if v is None else ",".join([f"{i:.6f}" for i in v]))


def _cells(calls: DataFrame) -> DataFrame:
    """calls (with contig, offset) with their text cells, each a column of its own, so that only those that are read are made.

    Fractions are rounded by C's rules, as printf does; all else is plain column work.
    """
    block = lambda h: F.struct(h["block_start"].alias("s"), h["block_end"].alias("e"))
    placed = F.array_sort(F.transform("hits", lambda h, i: F.struct(h["start"].alias("s"), i.alias("i"), h.alias("h"))))
    rows = calls.withColumn("_h", F.transform(placed, lambda x: x["h"]))
    # the first hit of each block, blocks in order
    real = F.filter("_h", lambda h: ~h["inserted"])
    rows = rows.withColumn("_b", F.array_sort(F.transform(real, lambda h, i: F.struct(block(h).alias("b"), i.alias("i"), h.alias("h")))))
    first = F.filter("_b", lambda x, i: (i == 0) | (x["b"] != F.get("_b", i - 1)["b"]))
    rows = rows.withColumns({"_b": F.transform(first, lambda x: x["h"]), "_x": F.filter("_h", lambda h: h["inserted"])})
    total = lambda items, c: F.aggregate(F.transform(items, lambda h: h[c]), F.lit(0).cast("long"), lambda a, x: a + x)
    text = lambda c: (c if isinstance(c, Column) else F.col(c)).cast("string")
    listed = lambda f, items="_h": F.array_join(F.transform(items, f), ",")
    offset = F.col("offset")
    span = lambda a, b: F.concat(text(offset + a), F.lit("-"), text(offset + b))
    bases, parent = total("_h", "bases"), F.col("model_type") == "full_gene"
    start, end = F.when(parent, F.col("hull_start")).otherwise(F.array_min("_h.start")), F.when(parent, F.col("hull_end")).otherwise(F.array_max("_h.end"))
    found, expected = F.size("found"), F.col("expected")
    skipped, labels = F.array_sort(F.array_distinct(F.transform("_x", block))), F.aggregate("runs", F.lit(0), lambda a, x: a + x)
    identity = _float_sum(F.transform("_h", lambda h: h["identity"] * h["bases"])) / bases
    number = F.col("gene_number").cast("string")
    cells = {
        "GENE_index": F.concat(F.lit("GENE_"), F.when(F.length(number) < 6, F.lpad(number, 6, "0")).otherwise(number)), "transcript_id": F.when(parent, F.col("gene_id")).otherwise(F.col("tid")),
        "gene_id": F.col("gene_id"), "gene_name": F.col("gene_name"), "transcript_type": F.col("transcript_type"), "ifmane_transcript": F.when(F.col("mane"), "1").otherwise("0"),
        "weighted_score": six_places(F.col("weighted")), "raw_exon_score": six_places(F.col("raw")), "total_aligned_bases": text(total(real, "bases")),
        "mean_identity": six_places(F.when(bases != 0, identity).otherwise(0.0)),
        "mean_exon_coverage": six_places(F.when(F.size("_h") > 0, _float_sum(F.transform("_h", lambda h: h["coverage"])) / F.size("_h")).otherwise(0.0)),
        "expected_exons": text(expected), "found_exons": text(found), "missing_exons": text(expected - found),
        "fraction_expected_found": six_places(F.when(expected != 0, found.cast("double") / expected).otherwise(0.0)), "found_exon_numbers": listed(lambda h: text(h["number"])),
        "query_id": F.col("query_id"), "query_contig": F.col("contig"), "query_start": text(offset + start), "query_end": text(offset + end), "strand": F.col("strand"),
        "exon_query_coordinates": listed(lambda h: span(h["start"], h["end"])),
        "exon_reference_coordinates": listed(lambda h: F.concat(h["ref_chrom"], F.lit(":"), text(h["ref_start"]), F.lit("-"), text(h["ref_end"]))), "exon_ids": listed(lambda h: h["exon_id"]),
        "exon_coverages": _listed_places("_h.coverage"), "exon_identities": _listed_places("_h.identity"), "alignment_AS": _listed_places("_h.alignment_score"),
        "call_status": F.when(expected == found, "complete").otherwise("partial"), "tie_group_id": F.col("tie_group_id"), "tie_count": text("tie_count"),
        "assignment_status": F.when(F.col("tie_count") > 1, "tied").otherwise("unique"), "pipeline_version": F.lit(VERSION),
        "merged_interval_coordinates": listed(lambda h: span(h["block_start"], h["block_end"]), "_b"), "merged_interval_gene_scores": _listed_six("_b.score"),
        "merged_interval_score_exon_ids": listed(lambda h: h["supplier_exon_id"], "_b"), "merged_interval_score_exon_lengths": listed(lambda h: text(h["supplier_length"]), "_b"),
        "transcript_exon_length": text("exon_length"), "model_type": F.col("model_type"), "inserted_exons": text(labels), "insertion_penalty": six_places(50.0 * labels),
        "inserted_exon_numbers": listed(lambda h: text(h["number"]), "_x"), "inserted_exon_query_coordinates": listed(lambda x: span(x["s"], x["e"]), skipped),
        "inserted_query_blocks": text(F.size(skipped)), "insertion_run_unique_exons": F.array_join(F.col("runs").cast("array<string>"), ","),
    }
    order = {
        "_gene_number": F.col("gene_number").cast("long"), "_parent": parent, "_weighted": F.col("weighted"), "_tid": F.col("tid"), "_from": offset + start, "_until": offset + end,
        "_fragment": F.col("is_fragment"), "_assignment": F.col("parent"),
    }
    return rows.select(*[cells[c].alias(c) for c in COLUMNS], *[v.alias(k) for k, v in order.items()])


def call_table(calls: DataFrame, suffixed_names: bool = False) -> DataFrame:
    """44 text columns, then row_order and is_fragment: one row an assignment, ties in one row.

    suffixed_names: query names end in _start_end, and coordinates are shifted by start.  A call without a tie group is a row as it
    is; only tied ones are put together: PAIRED columns ';'-joined, others once if equal, bounds of all.
    """
    contig, offset = S.query_location(F.col("query_id")) if suffixed_names else (F.col("query_id"), F.lit(0).cast("long"))
    made = calls.withColumns({"contig": contig, "offset": offset})
    row_order = lambda number, parent, weighted, tid: F.struct(number.alias("gene_number"), (~parent).alias("child"), (-weighted).alias("weight"), tid.alias("tid")).alias("row_order")
    alone = _cells(made.where("tie_group_id = ''"))
    order = ("_gene_number", "_parent", "_weighted", "_tid")
    alone = alone.select(*COLUMNS, row_order(*map(F.col, order)), F.col("_fragment").alias("is_fragment"))

    group = ["_assignment", "tie_group_id"]
    by = Window.partitionBy(*group).orderBy("gene_id", "transcript_id", "_from", "_until", "_tid", "exon_query_coordinates")
    tied = _cells(made.where("tie_group_id <> ''")).withColumn("_k", F.row_number().over(by))

    def values(c: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct("_k", F.col(c).alias("v")))), lambda x: x["v"])

    def cell(c: str) -> Column:
        all_ = F.array_join(values(c), ";")
        return all_ if c in PAIRED else F.when(F.min(c).eqNullSafe(F.max(c)), F.min(c)).otherwise(all_)

    several = F.count("*") > 1
    cells = {c: F.col(c) if c in group else cell(c) for c in COLUMNS} | {
        "query_start": F.min("_from").cast("string"), "query_end": F.max("_until").cast("string"), "tie_count": F.when(several, F.count("*").cast("string")).otherwise(F.min("tie_count")),
        "assignment_status": F.when(several, "tied").otherwise(F.min("assignment_status")),
    }
    joined = tied.groupBy(*group).agg(
        *[v.alias(c) for c, v in cells.items() if c not in group], row_order(F.min("_gene_number"), F.max("_parent"), F.max("_weighted"), F.max("_tid")),
        F.bool_or("_fragment").alias("is_fragment"),
    )
    return alone.unionByName(joined.select(*alone.columns))


def write_call_tables(table: DataFrame, main: str, fragments: str) -> None:
    """Two tab-separated tables, in row order over and within their part files, each with a header; the paths must differ."""
    if main == fragments:
        raise ValueError("main and fragment tables need different paths")
    for path, which in ((main, ~F.col("is_fragment")), (fragments, F.col("is_fragment"))):
        rows = table.where(which).orderBy("row_order").select(*COLUMNS)
        rows.write.csv(path, sep="\t", header=True, quote="", emptyValue="", mode="overwrite")


def legacy_table(table: DataFrame, truncated: DataFrame | None = None) -> DataFrame:
    """Sixteen columns without ties or hierarchy; a tied row or a gene model is an error.

    truncated: (transcript_id, low, high) of models that were cut to the exon numbers low to high, which then stand behind the id.
    """
    bad = (F.col("tie_count") != "1") | (F.col("model_type") == "full_gene")
    checked = F.when(bad, F.raise_error(F.lit("the legacy table holds neither ties nor gene models"))).otherwise(F.col("transcript_id"))
    if truncated is None:
        name = checked
    else:
        table = table.join(truncated, "transcript_id", "left")
        name = F.when(F.col("low").isNull(), checked).otherwise(F.concat(checked, F.lit("(:"), F.col("low").cast("string"), F.lit("-"), F.col("high").cast("string"), F.lit(")")))
    similarity = F.when(F.col("expected_exons").cast("int") > 0, F.col("raw_exon_score").cast("double") / F.col("expected_exons").cast("int")).otherwise(0.0)
    places = F.filter(F.split("exon_query_coordinates", ","), lambda x: x != "")
    side = lambda i: F.array_join(F.transform(places, lambda x: F.split(x, "-")[i]), ",")
    return table.select(
        name.alias("transcript_id"), "gene_id", "gene_name", "transcript_type", "total_aligned_bases", F.round(similarity, 6).cast("string").alias("similarity"), "expected_exons", "missing_exons",
        "found_exon_numbers", "query_contig", "query_start", "query_end", side(0).alias("exon_starts"), side(1).alias("exon_ends"),
        F.array_join(F.transform(places, lambda x: F.col("strand")), ",").alias("exon_strands"), "exon_ids",
    )


def overlap_groups(calls: DataFrame, hits: DataFrame, bin_size: int = 10_000) -> DataFrame:
    """For each call: the transcripts, genes and reference exons with evidence that strictly overlaps its hits, and where."""
    own = calls.select("query_id", "strand", "parent", "tid", F.explode("hits").alias("h")).select(
        "query_id", "strand", "parent", F.col("tid").alias("reported_transcript_id"), F.col("h.start").alias("s"), F.col("h.end").alias("e")
    )
    evidence = hits.select("query_id", "strand", F.col("tid").alias("c_tid"), F.col("gene").alias("c_gene"), "exon_id", "chrom", "start0", "end0", "query_start", "query_end")
    met = range_join(own, evidence, ["query_id", "strand"], bin_size, ("s", "e"), ("query_start", "query_end"))
    exon = F.concat(F.col("chrom"), F.lit(":"), F.col("start0").cast("string"), F.lit("-"), F.col("end0").cast("string"))
    # one set a call holds all that its lists are made of, so that a pair is shuffled once
    pair = F.struct("c_tid", "c_gene", exon.alias("exon"), F.struct(F.least("s", "query_start").alias("s"), F.greatest("e", "query_end").alias("e")).alias("span"))
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    key = ["query_id", "strand", "parent", "reported_transcript_id"]
    rows = met.groupBy(*key).agg(F.collect_set(pair).alias("p")).select(
        *key, listed("p.c_tid").alias("candidate_transcript_ids"), listed("p.c_gene").alias("candidate_gene_ids"), listed("p.exon").alias("candidate_reference_exons"),
        F.array_sort(F.array_distinct("p.span")).alias("r"),
    )
    # touching regions are one
    folded = F.aggregate(
        "r", F.slice("r", 1, 0),
        lambda a, x: F.when((F.size(a) > 0) & (F.get(a, F.size(a) - 1)["e"] >= x["s"]),
                            F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.get(a, F.size(a) - 1)["s"].alias("s"), F.greatest(F.get(a, F.size(a) - 1)["e"], x["e"]).alias("e")))))
        .otherwise(F.concat(a, F.array(x))),
    )
    text = F.array_join(F.transform(folded, lambda x: F.concat(x["s"].cast("string"), F.lit("-"), x["e"].cast("string"))), ",")
    return rows.select("query_id", "strand", "parent", "reported_transcript_id", "candidate_transcript_ids", "candidate_gene_ids", "candidate_reference_exons", text.alias("overlap_regions"))


def bed(table: DataFrame, haplotype: str = "") -> DataFrame:
    """BED12 and 31 more columns of the call table.  Blocks of tied rows are merged where they meet."""
    pairs = F.filter(F.split(F.regexp_replace("exon_query_coordinates", ";", ","), ","), lambda x: x != "")
    bound = lambda x, i: F.element_at(F.split(x, "-"), i).cast("long")
    blocks = F.array_sort(F.transform(pairs, lambda x: F.struct(F.least(bound(x, 1), bound(x, 2)).alias("s"), F.greatest(bound(x, 1), bound(x, 2)).alias("e"))))
    tied = F.col("exon_query_coordinates").contains(";")
    last = lambda a: F.get(a, F.size(a) - 1)
    union = F.aggregate(
        blocks, F.slice(blocks, 1, 0),
        lambda a, x: F.when((F.size(a) > 0) & (last(a)["e"] >= x["s"]),
                            F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(last(a)["s"].alias("s"), F.greatest(last(a)["e"], x["e"]).alias("e"))))).otherwise(F.concat(a, F.array(x))),
    )
    shape = lambda c: F.transform(F.split(c, ";"), lambda g: F.size(F.split(g, ",")))
    uneven = (F.col("exon_reference_coordinates") != "") & (shape("exon_query_coordinates") != shape("exon_reference_coordinates"))
    rows = table.withColumn("b", F.when(uneven, F.raise_error(F.lit("query and reference coordinates differ in shape"))).when(tied, union).otherwise(blocks))
    start = F.col("b")[0]["s"]
    fractions = F.transform(F.filter(F.split("fraction_expected_found", ";"), lambda x: x != ""), lambda x: x.cast("double"))
    mane = F.forall(F.split("ifmane_transcript", ";"), lambda x: x == "1")
    name = F.concat_ws("|", F.when(F.col("gene_name") != "", F.col("gene_name")).otherwise(F.col("gene_id")), "transcript_id", "call_status")
    listed = lambda f: F.concat(F.array_join(F.transform("b", lambda x: f(x).cast("string")), ","), F.lit(","))
    core = [
        F.col("query_contig").alias("chrom"), start.alias("chromStart"), F.array_max("b.e").alias("chromEnd"), name.alias("name"), S.bed_score(fractions).alias("score"),
        F.col("strand").alias("bed_strand"), start.alias("thickStart"), start.alias("thickEnd"), F.when(mane, "0,102,204").otherwise("96,96,96").alias("itemRgb"),
        F.size("b").alias("blockCount"), listed(lambda x: x["e"] - x["s"]).alias("blockSizes"), listed(lambda x: x["s"] - start).alias("blockStarts"), F.lit(haplotype).alias("haplotype"),
    ]
    return rows.select(*core, *BED_EXTRA[1:]).orderBy("chrom", "chromStart", "chromEnd", "name")


def write_legacy_table(legacy: DataFrame, path: str) -> None:
    """legacy_table() rows as tab-separated files without header, similarity with six places."""
    rows = legacy.withColumn("similarity", six_places(F.col("similarity").cast("double")))
    rows.write.csv(path, sep="\t", quote="", emptyValue="", mode="overwrite")


def write_by_sample(table: DataFrame, samples: DataFrame, sample: str, path: str) -> None:
    """One folder of tab-separated files a sample under `path`, in row order; a row of no known sample is an error.

    samples: (name), unique; `sample` names the table's column.  Samples are dealt by ranges of (sample, row order), so that
    one of any size is written by several tasks.
    """
    stray = table.join(samples, table[sample] == samples["name"], "left_anti").select(sample).distinct().limit(5).collect()
    if stray:
        raise ValueError(f"rows of unknown samples: {[r[0] for r in stray]}")
    rows = table.withColumn("sample", F.col(sample))
    order = ["sample", *[c for c in ("row_order",) if c in table.columns]]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row_order").write.partitionBy("sample").csv(path, sep="\t", header=True, quote="", emptyValue="", mode="overwrite")


def valid_call_table(table: DataFrame) -> bool:
    """Whether a table that was read again is one of this version: its columns, none of older layouts, its first row."""
    old = {"transcript_id_full", "gene_id_full", "alternatives_json"}
    needed = {
        "query_contig", "transcript_id", "call_status", "tie_group_id", "tie_count", "assignment_status", "pipeline_version", "model_type", "GENE_index",
        "inserted_exons", "insertion_penalty", "insertion_run_unique_exons",
    }
    if not needed <= set(table.columns) or old & set(table.columns):
        return False
    first = table.select("pipeline_version").first()
    return first is None or first[0] == VERSION
