"""Calls on real annotation and exon alignments of some genes, where a folder of such files is at hand; it is read only.

Values that must come out are fixed: places, exon counts and scores of genes on an assembly.
"""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lociweave.plans import annotation as A
from lociweave.plans import calls as C
from lociweave.plans import reports
from lociweave.sources import readers as R
from lociweave.sources.tables import paralog_report

FOLDER = os.environ.get("SAVED_GENES")


def saved(gene, ending):
    found = sorted(Path(FOLDER).rglob(f"{gene}_*{ending}")) if FOLDER else []
    if not found:
        pytest.skip(f"no saved {ending} of {gene}")
    return str(found[0])


def called(spark, gene, **options):
    """Rows of the call table as dicts, and the report of gene models."""
    a = A.annotation(R.gff3(spark, saved(gene, ".gff3")))
    eligible = R.exon_ids(spark, saved(gene, ".exon_ids.tsv"))
    calls, report = C.call_genes(R.alignments(spark, saved(gene, ".alignments.tsv")), a, C.Options(**options), eligible)
    table = reports.call_table(calls)
    return [r.asDict() for r in table.orderBy("row_order").collect()], report


def test_survival_motor_neuron_transcripts(spark):
    rows, _ = called(spark, "SMN", two_stage=False)
    assert {g for r in rows for g in r["gene_name"].split(";")} <= {"SMN1", "SMN2"}
    mane = [r for r in rows if r["ifmane_transcript"] == "1"]
    assert {(r["gene_name"], r["transcript_id"], r["query_start"], r["strand"]) for r in mane} == {
        ("SMN1", "ENST00000380707", "71381874", "+"), ("SMN2", "ENST00000380743", "70809743", "-")
    }
    assert {(r["found_exons"], r["call_status"], r["assignment_status"]) for r in mane} == {("9", "complete", "unique")}
    assert {len(r["merged_interval_coordinates"].split(",")) for r in mane} == {8}
    score = {r["strand"]: float(r["weighted_score"]) for r in mane}
    assert score["+"] == pytest.approx(15960.199005, abs=5e-6) and score["-"] == pytest.approx(15841.095017, abs=5e-6)


def test_survival_motor_neuron_genes(spark):
    rows, _ = called(spark, "SMN")
    assert len(reports.COLUMNS) == 44 and not any(r["is_fragment"] for r in rows)
    full = [r for r in rows if r["model_type"] == "full_gene" and r["call_status"] == "complete"]
    assert {(r["gene_name"], r["strand"]) for r in full} == {("SMN1", "+"), ("SMN2", "-")}
    assert {r["assignment_status"] for r in full} == {"unique"}
    mane = [r for r in rows if r["ifmane_transcript"] == "1" and r["found_exons"] == "9"]
    assert {(r["gene_name"], r["strand"], r["query_start"], r["query_end"]) for r in mane} == {
        ("SMN1", "+", "71381874", "71409804"), ("SMN2", "-", "70809743", "70837675")
    }


def test_one_long_gene_and_its_transcripts(spark):
    rows, report = called(spark, "C4orf50")
    assert len(rows) == 4 and len({r["GENE_index"] for r in rows}) == 1
    gene = rows[0]
    assert (gene["transcript_id"], gene["gene_id"], gene["ifmane_transcript"]) == ("ENSG00000181215", "ENSG00000181215", "0")
    assert (gene["found_exons"], gene["expected_exons"], gene["call_status"]) == ("35", "35", "complete")
    assert (gene["query_start"], gene["query_end"]) == ("5869135", "6174552")
    assert report.count() == 35
    rows, _ = called(spark, "C4orf50", two_stage=False)
    assert {r["transcript_id"] for r in rows} == {"ENST00000711657", "ENST00000531445", "ENST00000639345"}
    assert {r["model_type"] for r in rows} == {"transcript"}


def test_genes_of_one_locus_share_a_model(spark):
    a = A.annotation(R.gff3(spark, saved("MUC20", ".gff3")))
    assert a.transcripts.count() == 258
    united, report = A.with_full_genes(a)
    unit = A.shared_report(A.shared_exon_units(a.exons)).collect()
    assert [(u["merged_gene_name"], u["merged_gene_id"], u["max_pair_shared_exonic_bp"]) for u in unit] == [
        ("MUC20&MUC20-OT1", "ENSG00000176945&ENSG00000242086", 1851)
    ]
    assert report.count() == 48
    kept = united.transcripts.where("model_type = 'transcript'")
    assert kept.count() == 258 and kept.select("gene_id").distinct().count() == 1
    assert kept.where("tid = 'ENST00000447234'").first()["mane"]


def test_identical_paralogs_stand_for_one_gene(spark):
    a = A.annotation(R.gff3(spark, saved("AMY", ".gff3")))
    assert (a.exons.select("gene_id").distinct().count(), a.transcripts.count(), a.exons.count()) == (6, 45, 395)
    report = paralog_report(spark, saved("AMY", ".identical_paralogs.tsv"))
    one = A.with_representatives(a, report)
    names = {r["gene_name"] for r in one.transcripts.select("gene_name").distinct().collect()}
    assert "AMY1Amerged" in names and not names & {"AMY1A", "AMY1B", "AMY1C"} and len(names) == 4
    left = one.transcripts.where(F.col("gene_name") == "AMY1Amerged").select("gene_id").distinct().count()
    assert left == 1 and one.exons.select("gene_id").distinct().count() == 4
