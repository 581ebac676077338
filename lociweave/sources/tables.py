"""Checked readers of the tables that the plans write, and of sample lists."""

from __future__ import annotations

import os
import shlex

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.plans.exon_tables import ALIASES
from lociweave.sources.readers import lines, table

SAFE_NAME = "[A-Za-z0-9_.-]+"
#: Columns of the two gene reports, in order (fixed values).
PARALOGS = "representative_gene_id representative_gene_name merged_gene_name gene_ids gene_names mane_transcript_ids mane_sequence_lengths mane_sequence_sha256".split()
SHARED = "merged_gene_id merged_gene_name reference_contig strand member_gene_ids member_gene_names max_pair_shared_exonic_bp".split()
OFFSETS = ["query_core_start0", "query_core_end0", "query_anchor_start0", "query_anchor_end0"]


def _checked(rows: DataFrame, good: Column, message: str) -> DataFrame:
    """rows, of which one that is not good is an error when it is read."""
    first = rows.columns[0]
    bad = F.raise_error(F.concat(F.lit(f"{message}: "), F.coalesce(F.col(first).cast("string"), F.lit(""))))
    return rows.withColumn(first, F.when(F.coalesce(good, F.lit(False)), F.col(first)).otherwise(bad))


def exon_info(spark: SparkSession, path: str) -> DataFrame:
    """Typed exon records; rows whose length is no number are left out, other numbers that are none are 0."""
    rows = table(spark, path, ["exon_id_full", "exon_id", "length"]).withColumn("length", F.col("length").try_cast("long")).where("length IS NOT NULL")
    numbers = [c for c in ("start0", "end0", "left_anchor_length", "right_anchor_length", "anchored_length", "unmasked_ACGT") if c in rows.columns]
    return rows.withColumns({c: F.coalesce(F.col(c).try_cast("long"), F.lit(0)) for c in numbers})


def exon_aliases(spark: SparkSession, path: str) -> DataFrame:
    """Typed aliases, one a (record, exon, place); columns that older tables lack are null, anchors 0 and '' where text.

    Offsets in the query are all there or none; those that are no interval of the exon's length in its anchored one are an error.
    """
    rows = table(spark, path, ["blast_exon_id_full", "exon_id_full", "exon_id", "chrom", "start0", "end0", "strand", "length"])
    whole = ["start0", "end0", "length", "left_anchor_length", "right_anchor_length", "anchored_length", *OFFSETS, "gene_start0", "gene_end0"]
    had = set(rows.columns)
    cell = lambda c: F.col(c).try_cast("long") if c in had else F.lit(None).cast("long")
    made = rows.select(*[(cell(c) if c in whole else F.col(c) if c in had else F.lit("")).alias(c) for c in ALIASES])
    zero = F.lit(0).cast("long")
    made = made.withColumns({
        "left_anchor_length": F.coalesce("left_anchor_length", zero), "right_anchor_length": F.coalesce("right_anchor_length", zero),
        "anchored_length": F.coalesce("anchored_length", "length"),
    })
    a, b, x, y = [F.col(c) for c in OFFSETS]
    none = a.isNull() & b.isNull() & x.isNull() & y.isNull()
    inside = (x >= 0) & (x <= a) & (a < b) & (b <= y) & (b - a == F.col("length")) & (y - x == F.col("anchored_length"))
    typed = F.col("start0").isNotNull() & F.col("end0").isNotNull() & F.col("length").isNotNull()
    checked = _checked(made, typed & (none | F.coalesce(inside, F.lit(False))), f"{path}: invalid place of an exon")
    return checked.dropDuplicates(["blast_exon_id_full", "exon_id_full", "chrom", "start0", "end0", "strand"])


def _members(rows: DataFrame, ids: str, *where: str) -> None:
    """No gene may stand in two groups, or twice in one."""
    twice = rows.select(*where, F.explode(F.split(ids, ";")).alias("g")).groupBy(*where, "g").count().where("count > 1").first()
    if twice:
        raise ValueError(f"gene {twice['g']!r} is in more than one group")


def paralog_report(spark: SparkSession, path: str) -> DataFrame:
    """Sets of identical paralogs, checked: two or more genes each, as many cells in every list, the first one named."""
    rows = table(spark, path, PARALOGS)
    ids, names = F.split("gene_ids", ";"), F.split("gene_names", ";")
    good = (F.size(ids) >= 2) & (F.size(ids) == F.size(names)) & ~F.array_contains(ids, "")
    good &= (F.col("representative_gene_id") == ids[0]) & (F.col("representative_gene_name") == names[0]) & (F.col("merged_gene_name") == F.concat(names[0], F.lit("merged")))
    for c in PARALOGS[5:]:
        good &= F.size(F.split(c, ";")) == F.size(ids)
    _members(rows, "gene_ids")
    return _checked(rows, good, f"{path}: invalid paralog group")


def shared_gene_report(spark: SparkSession, path: str, threshold: int = 100) -> DataFrame:
    """Units of genes that share exonic bases, checked; the columns must be the seven, in order."""
    rows = table(spark, path)
    if rows.columns != SHARED:
        raise ValueError(f"{path}: columns {rows.columns}")
    ids, names, shared = F.split("member_gene_ids", ";"), F.split("member_gene_names", ";"), F.col("max_pair_shared_exonic_bp").try_cast("long")
    good = (F.size(ids) >= 2) & (F.size(ids) == F.size(names)) & ~F.array_contains(ids, "") & ~F.array_contains(names, "") & F.col("strand").isin("+", "-")
    good &= (F.col("reference_contig") != "") & (F.col("merged_gene_id") == F.array_join(ids, "&")) & (F.col("merged_gene_name") == F.array_join(names, "&")) & (shared > threshold)
    _members(rows, "member_gene_ids", "reference_contig", "strand")
    return _checked(rows, good, f"{path}: invalid unit").withColumn("max_pair_shared_exonic_bp", shared)


def sample_list(spark: SparkSession, path: str) -> DataFrame:
    """(name, fasta) of lines `name path`, quoted as a shell does; blank lines and those that begin with '#' are left out.

    Relative paths are read from the list's folder.  Names must be unique and safe.  A list is one line a sample, and small.
    """
    found = {}
    for row in lines(spark, path).orderBy("ord").collect():
        text = row["value"].strip()
        if not text or text.startswith("#"):
            continue
        cells = shlex.split(text)
        if len(cells) != 2:
            raise ValueError(f"{path}: expected a name and a path: {text!r}")
        name, fasta = cells
        found.setdefault(name, []).append(fasta if "://" in fasta else os.path.join(os.path.dirname(path), os.path.expanduser(fasta)))
    twice = [n for n, paths in found.items() if len(paths) > 1]
    if twice or not found:
        raise ValueError(f"{path}: repeated samples {twice}" if twice else f"{path}: no samples")
    names = spark.createDataFrame([(n, p[0]) for n, p in found.items()], "name string, fasta string")
    return checked_names(names)


def checked_names(names: DataFrame) -> DataFrame:
    """names (column `name`), after a look at them: unique, of letters, digits, '.', '_' and '-', and not '.' or '..'."""
    unsafe = ~F.col("name").rlike(f"^{SAFE_NAME}$") | F.col("name").isin(".", "..") | F.col("name").isNull()
    bad = names.groupBy("name").agg(F.count("*").alias("n")).where((F.col("n") > 1) | unsafe).first()
    if bad:
        raise ValueError(f"sample name {bad['name']!r} is repeated or unsafe")
    return names


def sample_names(records: DataFrame) -> DataFrame:
    """(name) of fasta() records that are samples each: names as in checked_names, no empty sequence, at least one record."""
    empty = records.where("seq IS NULL OR seq = ''").select("name").first()
    if empty:
        raise ValueError(f"record {empty['name']!r} has no sequence")
    names = checked_names(records.select("name"))
    if names.isEmpty():
        raise ValueError("no records")
    return names
