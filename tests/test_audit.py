import json

import pytest
from pyspark.sql import functions as F
from test_calls import HEAD, aligned, exon_line

from lociweave.plans import annotation as A
from lociweave.plans import audit
from lociweave.plans import calls as C
from lociweave.plans.evidence import expected_exons
from lociweave.sources import manifests as M
from lociweave.sources import readers as R
from lociweave.storage import written


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Two genes at one place: GA of exons E1, E2 and E5 (never aligned), GB of E3, which is shorter than E1 and loses, E4 (not eligible) and E6."""
    folder = tmp_path_factory.mktemp("audit")
    text = "".join(exon_line("chr1", s, s + 100, "GA", "TA", n, e) for n, e, s in ((1, "E1", 100), (2, "E2", 300), (3, "E5", 500)))
    text += exon_line("chr2", 100, 160, "GB", "TB", 1, "E3") + exon_line("chr2", 300, 360, "GB", "TB", 2, "E4") + exon_line("chr2", 500, 560, "GB", "TB", 3, "E6")
    (folder / "a.gff3").write_text(text)
    (folder / "a.tsv").write_text(HEAD + aligned("s", 100, 200, "E1") + aligned("s", 300, 400, "E2") + aligned("s", 100, 160, "E3"))
    a = A.annotation(R.gff3(spark, str(folder / "a.gff3")))
    eligible = spark.createDataFrame([(e,) for e in ("E1", "E2", "E3", "E5", "E6")], "exon_id string")
    hits = written(C.scored_hits(R.alignments(spark, str(folder / "a.tsv")), a, eligible))
    expected = expected_exons(a.assoc(), eligible)
    o = C.Options(two_stage=False)
    candidates = written(C.chains(C.chain_groups(hits, a, expected), o.coding_bonus, o))
    return a, eligible, hits, expected, candidates, written(C.resolved(candidates, True))


def test_blocks_and_exons(made):
    a, eligible, hits, _, _, calls = made
    names = audit.block_names(hits)
    blocks = {(r.block, r.gene): r for r in audit.block_report(hits, names).collect()}
    assert set(blocks) == {("plus.B01", "GA"), ("plus.B02", "GA"), ("plus.B01", "GB")}
    first = blocks["plus.B01", "GA"]
    assert (first.supplier_exon, first.supplier_length, first.supplier_identical_bases, first.alignments, first.exon_ids) == ("E1", 100, 100, 1, "E1")
    exons = {(r.gene, r.exon_id): r for r in audit.exon_report(a, hits, calls, names, eligible).collect()}
    assert {k: r.status for k, r in exons.items()} == {
        ("GA", "E1"): "aligned", ("GA", "E2"): "aligned", ("GA", "E5"): "no alignment", ("GB", "E3"): "aligned", ("GB", "E4"): "not eligible",
        ("GB", "E6"): "no alignment",
    }
    assert exons["GA", "E2"].selected_transcripts == "TA" and exons["GB", "E3"].selected_transcripts is None
    assert exons["GA", "E1"].supplies_score and exons["GA", "E5"].query_start is None and exons["GA", "E5"].transcripts == "TA"


def test_chains_and_transcripts(made):
    a, _, _, expected, candidates, calls = made
    chains = {r.tid: (r.outcome, r.chain_hits, r.selected_hits) for r in audit.chain_report(candidates, calls).collect()}
    assert chains == {"TA": ("selected whole", 2, 2), "TB": ("lost", 1, 0)}
    parts = audit.contributions(candidates)
    for r in parts.groupBy("tid").agg(F.sum("contribution").alias("s"), F.max("raw").alias("raw")).collect():
        assert r.s == pytest.approx(r.raw)
    got = {r.tid: (r.exons, r.expected, r.chains, r.selected) for r in audit.transcript_inventory(a, expected, candidates, calls).collect()}
    assert got == {"TA": (3, 3, 1, 1), "TB": (3, 2, 1, 0)}


def test_a_part_of_a_chain_is_its_residual(made):
    candidates = made[4].where("tid = 'TA'")
    part = candidates.withColumn("hits", F.slice("hits", 2, 1)).withColumn("tie_count", F.lit(1))
    row = audit.chain_report(candidates, part).first()
    assert (row.outcome, row.chain_hits, row.selected_hits) == ("selected residual", 2, 1)


def test_an_audit_is_written_whole(spark, made, tmp_path):
    a, eligible, hits, expected, candidates, calls = made
    (tmp_path / "in.txt").write_text("x")
    out = (tmp_path / "audit").as_uri()
    facts = audit.write_audit(spark, out, a, hits, expected, candidates, calls, C.Options(two_stage=False), eligible, (str(tmp_path / "in.txt"),))
    assert facts["rows"] == {"blocks": 3, "exons": 6, "chains": 2, "contributions": 3, "transcripts": 2}
    assert facts["inputs"][0]["size"] == 1 and facts["options"]["max_chains"] == 10 and not facts["options"]["two_stage"]
    assert M.read_json(spark, f"{out}/provenance.json") == facts
    records = {r["tid"]: r for r in (json.loads(x.value) for x in spark.read.text(f"{out}/chains.jsonl").collect())}
    assert {t: r["outcome"] for t, r in records.items()} == {"TA": "selected whole", "TB": "lost"}
    for r in records.values():
        assert sum(e["contribution"] for e in r["exons"]) == pytest.approx(r["raw"]) and not r["inserted_exons"]
    assert [e["exon_id"] for e in records["TA"]["exons"]] == ["E1", "E2"]
    chains = spark.read.csv(f"{out}/chains", sep="\t", header=True)
    assert "hits" not in chains.columns and {r.tid: r.found for r in chains.collect()} == {"TA": "1,2", "TB": "1"}


def test_an_audit_of_nothing(spark, made, tmp_path):
    a, eligible, hits, expected, candidates, calls = made
    facts = audit.write_audit(spark, (tmp_path / "none").as_uri(), a, hits.limit(0), expected, candidates.limit(0), calls.limit(0))
    assert facts["rows"] == {"blocks": 0, "exons": 0, "chains": 0, "contributions": 0, "transcripts": 2}


def test_options_out_of_range_are_refused():
    for wrong in ({"max_chains": 0}, {"shared_bases": -1}, {"coding_bonus": 0.0}, {"mane_bonus": float("inf")}, {"complete_bonus": float("nan")}):
        with pytest.raises(ValueError):
            C.Options(**wrong)


def test_manifests(spark, tmp_path):
    folder, reference, genes = tmp_path / "db", tmp_path / "r.fa", tmp_path / "g.gff3"
    folder.mkdir()
    reference.write_text(">a\nACGT\n")
    genes.write_text("#\n")
    db, of = str(folder), (str(reference), str(genes), {"anchor": 150})
    assert M.state_of(spark, db) == "missing exon_info"
    for name, columns in M.PARTS.items():
        (folder / name).mkdir()
        (folder / name / "part-0.csv").write_text("\t".join(columns) + "\n" + "\t".join("1" for _ in columns) + "\n")
    (folder / "exons.fa").write_text(">" + "\t".join("x" * 10) + "\nACGT\n")
    (folder / "exons.seq").write_text("x\n")
    for name in (M.PARALOG_REPORT, M.SHARED_REPORT):
        (folder / name).write_text("a\tb\n")
    assert M.report_beside(spark, f"{db}/exon_info") == f"{db}/{M.PARALOG_REPORT}" and M.report_beside(spark, f"{db}/exon_info/x") is None
    M.write_manifest(spark, db, *of)
    M.write_manifest(spark, db, *of)
    assert [f.name for f in folder.iterdir() if f.name.startswith("manifest")] == ["manifest.json"]
    assert M.state_of(spark, db, *of) == M.state_of(spark, db) == ""
    assert M.state_of(spark, db, *of[:2], {"anchor": 100}) == "settings changed"
    reference.write_text(">a\nACGTA\n")
    assert M.state_of(spark, db, *of) == "reference changed"
    (folder / M.SHARED_REPORT).write_text("a\tc\n")
    assert M.state_of(spark, db) == f"{M.SHARED_REPORT} has changed"
    (folder / ".manifest.json.crc").unlink()  # as another writer leaves none
    (folder / "manifest.json").write_text("{")
    assert M.state_of(spark, db) == "the manifest is no JSON"
