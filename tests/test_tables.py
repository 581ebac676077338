import hashlib
import random

import pytest
from pyspark.sql import functions as F
from test_search import EXONS, exon

from lociweave.plans import annotation as A
from lociweave.plans import exon_database as D
from lociweave.plans import exon_tables as T
from lociweave.plans import reports as R
from lociweave.plans import search as S
from lociweave.sources import readers, tables

FLIP = str.maketrans("ACGT", "TGCA")


def oriented(text, strand):
    return text if strand == "+" else text.translate(FLIP)[::-1]


@pytest.mark.parametrize("strand", ["+", "-"])
def test_exon_tables_hold_what_was_written(spark, tmp_path, strand):
    rng = random.Random(3)
    contig = [rng.choice("ACGT") for _ in range(6000)]
    contig[5000:5400] = contig[1900:2300]  # exon 5 again, with all of its surroundings
    contig = "".join(contig)
    spans = {1: (500, 600), 2: (550, 700), 3: (900, 1000), 5: (2000, 2200), 6: (5100, 5300)}
    rows = [exon(i, s, e, "G" if i < 4 else f"H{i}", strand) for i, (s, e) in spans.items()]
    collapsed = T.with_gene_bounds(D.collapse_exons(spark.createDataFrame(rows, EXONS)))
    genome = spark.createDataFrame([("c", contig)], "name string, seq string")
    aliases = D.union_queries(D.anchored(collapsed, genome))
    records = T.query_records(aliases, D.query_sequences(aliases, genome))
    leads = T.representatives(records)
    info = T.info_rows(leads)
    folder = str(tmp_path / "db")
    T.write_exon_tables(info, T.alias_rows(aliases, records, leads), folder)

    fasta = {r.name: r.seq for r in readers.fasta(spark, f"{folder}/exons.fa", strict=True).collect()}
    names = [r.name for r in readers.ordinals(spark, f"{folder}/exons.seq").orderBy("ordinal").collect()]
    got = {r.exon_id_full: r for r in tables.exon_info(spark, f"{folder}/exon_info").collect()}
    assert set(names) == set(fasta) == set(got) and len(names) == 3
    for name, r in got.items():
        left, right = (r.left_anchor_length, r.right_anchor_length) if strand == "+" else (r.right_anchor_length, r.left_anchor_length)
        assert fasta[name] == oriented(contig[r.start0 - left : r.end0 + right], strand)
        assert r.length == r.end0 - r.start0 and r.anchored_length == len(fasta[name]) == r.unmasked_ACGT
    every = tables.exon_aliases(spark, f"{folder}/exon_aliases").collect()
    assert {a.exon_id_full: a.merge_reason for a in every} == {
        "E1": "same_gene_overlap", "E2": "same_gene_overlap", "E3": "representative", "E5": "representative", "E6": "exact_sequence",
    }
    for a in every:
        assert fasta[a.blast_exon_id_full][a.query_core_start0 : a.query_core_end0] == oriented(contig[a.start0 : a.end0], strand)
        assert (a.gene_start0, a.gene_end0) == ((500, 1000) if a.gene_id == "G" else (a.start0, a.end0))
    union = next(r for r in got.values() if r.gene_name == "G" and r.transcript_id == "T1,T2")
    assert (union.start0, union.end0, union.transcript_index, union.ifmane_transcript, union.ifproteincoding) == (500, 700, "1,1", "1", "1")
    assert readers.table(spark, f"{folder}/exon_info").columns == T.INFO and readers.table(spark, f"{folder}/exon_aliases").columns == T.ALIASES


def test_aliases_outside_their_query_are_errors(spark, tmp_path):
    head = "blast_exon_id_full exon_id_full exon_id chrom start0 end0 strand length anchored_length query_core_start0 query_core_end0 query_anchor_start0 query_anchor_end0".split()
    row = "Q E E c 10 20 + 10 14 2 12 0 14".split()
    path = tmp_path / "a.tsv"
    for cells, fine in ((row, True), (row[:-1] + ["15"], False), (row[:9] + ["3"] + row[10:], False), (row[:-1] + [""], False), (row[:9] + [""] * 4, True), (row[:7] + [""] + row[8:], False)):
        path.write_text("\t".join(head) + "\n" + "\t".join(cells) + "\n" + "\t".join(cells) + "\n")
        if fine:
            assert tables.exon_aliases(spark, str(path)).count() == 1
        else:
            with pytest.raises(Exception, match="invalid place"):
                tables.exon_aliases(spark, str(path)).collect()


def test_paralog_report_and_its_checks(spark, tmp_path):
    genome = spark.createDataFrame([("c", "AACCGGTTAC" * 6)], "name string, seq string")
    rows = [exon(1, 0, 10, "GA"), exon(2, 30, 40, "GB"), exon(3, 1, 11, "GC")]
    mane = spark.createDataFrame([("GA", "T1"), ("GB", "T2"), ("GC", "T3")], "gene_id string, tid string")
    made = D.identical_paralogs(spark.createDataFrame(rows, EXONS), mane, genome).select(*tables.PARALOGS)
    digest = hashlib.sha256(b"AACCGGTTAC").hexdigest()
    want = ("GA", "GA", "GAmerged", "GA;GB", "GA;GB", "T1;T2", "10;10", f"{digest};{digest}")
    assert [tuple(r) for r in made.collect()] == [want]
    path = tmp_path / "p.tsv"
    for cells, fine in ((want, True), (("GB", *want[1:]), False), ((*want[:3], "GA;GA", *want[4:]), False), ((*want[:6], "10", want[7]), False)):
        path.write_text("\t".join(tables.PARALOGS) + "\n" + "\t".join(cells) + "\n")
        if fine:
            assert [tuple(r) for r in tables.paralog_report(spark, str(path)).collect()] == [want]
        else:
            with pytest.raises(Exception, match="more than one group|invalid paralog"):
                tables.paralog_report(spark, str(path)).collect()


def test_shared_report_and_its_checks(spark, tmp_path):
    rows = [exon(1, 0, 500, "GA"), exon(2, 100, 600, "GB"), exon(3, 550, 900, "GC"), exon(4, 0, 500, "GD", "-")]
    exons = spark.createDataFrame(rows, EXONS).withColumn("gene_id_full", F.col("gene_id"))
    report = A.shared_report(A.shared_exon_units(exons))
    assert [tuple(r) for r in report.collect()] == [("GA&GB", "GA&GB", "c", "+", "GA;GB", "GA;GB", 400)] and report.columns == tables.SHARED
    report.write.csv(str(tmp_path / "s"), sep="\t", header=True)
    assert tables.shared_gene_report(spark, str(tmp_path / "s")).first().max_pair_shared_exonic_bp == 400
    with pytest.raises(Exception, match="invalid unit"):
        tables.shared_gene_report(spark, str(tmp_path / "s"), 400).collect()


def test_alignment_rows_round_as_c_does(spark, tmp_path):
    line = "q\t0\tE1.2\t11\t60\t3S10M2I5M1S\t*\t0\t0\t*\t*"
    (tmp_path / "a.sam").write_text(f"{line}\tAS:i:12\tNM:i:2\tEV:f:1.5e-9\n{line.replace('E1.2', 'E9')}\tPI:f:50.0000005\n")
    exons = spark.createDataFrame([("E1.7", "E1", 50)], "exon_id_full string, exon_id string, length long")
    made = T.sam_alignments(readers.sam(spark, str(tmp_path / "a.sam")), exons)
    got = {r.exon_id: tuple(r) for r in T.alignment_rows(made).collect()}
    pi = 100 * 15 / 17
    assert got["E1"] == ("q", f"{pi:.6f}", "3", "20", "+", "E1", "E1.7", "50", "10", "25", "15", "30.000000", "15", "12.000000", "2", "1.5e-09", "3S10M2I5M1S", "E1.2")
    assert got["E9"][1] == f"{50.0000005:.6f}" and got["E9"][7] == "25" and got["E9"][12] == "9"
    old = T.alignment_rows(made, legacy=True)
    assert len(old.columns) == 13 and old.where("exon_id = 'E1'").first()[12] == "12.000000"
    again = made.join(made.select("exon_id"), "exon_id", "left_semi").where("exon_id = 'E1'").select(*[n for n, _ in readers.ALIGNMENT])
    T.alignment_rows(again).write.csv(str(tmp_path / "rows"), sep="\t")
    back = readers.alignments(spark, str(tmp_path / "rows")).first()
    assert (back.query_id, back.exon_id, back.exon_length, back.identical_bases, back.evalue) == ("q", "E1", 50, 15, 1.5e-9)


def test_samples(spark, tmp_path):
    path = tmp_path / "list"
    path.write_text("# names\n\ns1 'a b.fa'\ns.2 /x/y.fa\n")
    assert {r.name: r.fasta for r in tables.sample_list(spark, str(path)).collect()} == {"s1": f"{tmp_path}/a b.fa", "s.2": "/x/y.fa"}
    for text in ("s1 a\ns1 b\n", "s/1 a\n", ".. a\n", "s1\n", "# none\n"):
        path.write_text(text)
        with pytest.raises(ValueError):
            tables.sample_list(spark, str(path))
    fasta = tmp_path / "a.fa"
    fasta.write_text(">x one\nAC\n>y\nGT\n")
    assert sorted(r.name for r in tables.sample_names(readers.fasta(spark, str(fasta))).collect()) == ["x", "y"]
    for text in (">x\nAC\n>x\nGT\n", ">x\n>y\nGT\n", ">x:1\nAC\n"):
        fasta.write_text(text)
        with pytest.raises(ValueError):
            tables.sample_names(readers.fasta(spark, str(fasta)))


def test_tables_by_sample_and_their_validity(spark, tmp_path):
    table = spark.createDataFrame([("a", "1", 2), ("b", "2", 1), ("a", "3", 1)], "query_id string, v string, row_order long")
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    R.write_by_sample(table, names, "query_id", str(tmp_path / "out"))
    back = spark.read.csv(str(tmp_path / "out" / "sample=a"), sep="\t", header=True)
    assert sorted((r.query_id, r.v) for r in back.collect()) == [("a", "1"), ("a", "3")]
    with pytest.raises(ValueError, match="unknown samples"):
        R.write_by_sample(table, names.where("name <> 'b'"), "query_id", str(tmp_path / "no"))
    whole = spark.createDataFrame([tuple(R.VERSION for _ in R.COLUMNS)], ", ".join(f"{c} string" for c in R.COLUMNS))
    assert R.valid_call_table(whole) and R.valid_call_table(whole.limit(0)) and not R.valid_call_table(whole.drop("tie_count"))
    assert not R.valid_call_table(whole.withColumn("gene_id_full", F.lit(""))) and not R.valid_call_table(whole.withColumn("pipeline_version", F.lit("2")))


def test_legacy_rows(spark, tmp_path):
    cells = {c: "" for c in R.COLUMNS} | {
        "transcript_id": "T", "tie_count": "1", "model_type": "transcript", "raw_exon_score": "100.000000", "expected_exons": "3", "strand": "-",
        "exon_query_coordinates": "5-9,20-30", "exon_ids": "A,B",
    }
    table = spark.createDataFrame([tuple(cells[c] for c in R.COLUMNS)], ", ".join(f"{c} string" for c in R.COLUMNS))
    row = R.legacy_table(table, spark.createDataFrame([("T", 2, 4)], "transcript_id string, low int, high int")).first()
    assert len(row) == 16 and (row.transcript_id, row.similarity, row.exon_starts, row.exon_ends, row.exon_strands) == ("T(:2-4)", "33.333333", "5,20", "9,30", "-,-")
    assert R.legacy_table(table).first().transcript_id == "T"
    R.write_legacy_table(R.legacy_table(table.withColumn("expected_exons", F.lit("4"))), str(tmp_path / "old"))
    cells = spark.read.text(str(tmp_path / "old")).first()[0].split("\t")
    assert len(cells) == 16 and cells[5] == "25.000000" and cells[15] == "A,B"
    with pytest.raises(Exception, match="legacy"):
        R.legacy_table(table.withColumn("tie_count", F.lit("2"))).collect()


def test_window_balance_equals_a_count(spark):
    rng = random.Random(5)
    windows = [(g, c, s, s + 100) for g in "gh" for c in "cd" for s in (0, 200, 400)]
    expected = [("g", "x"), ("g", "y"), ("h", "x")]
    hits = [(g, c, rng.choice("xyz"), rng.choice("+-"), s + o, s + o + 20) for g, c, s, _ in windows for o in [rng.randrange(0, 100) for _ in range(rng.randrange(5))]]
    hits += [h for h in hits[:5]]

    def balanced(g, c, low, high):
        counts = {e: 0 for q, e in expected if q == g}
        for e in counts:
            for strand in "+-":
                end = -1
                for s, t in sorted((h[4], h[5]) for h in hits if h[:4] == (g, c, e, strand) and h[4] >= low and h[5] <= high):
                    counts[e] += s >= end
                    end = max(end, t)
        return len(set(counts.values())) == 1 and min(counts.values()) > 0

    made = S.window_balance(
        spark.createDataFrame(windows, "gene string, contig string, window_start long, window_end long"),
        spark.createDataFrame(hits, "gene string, contig string, exon string, strand string, start long, end long"),
        spark.createDataFrame(expected, "gene string, exon string"), 64,
    )
    got = {(r.gene, r.contig, r.window_start, r.window_end): r.balanced for r in made.collect()}
    assert got == {w: balanced(*w) for w in windows} and len(set(got.values())) == 2
    seeds, genes = spark.createDataFrame([("q",), ("q",)], "query string"), spark.createDataFrame([("g",), ("h",)], "gene string")
    row = S.search_counters(seeds, genes, spark.createDataFrame([("q", "g")], "query string, gene string"), made).first()
    assert (row.n_seeds, row.n_genes, row.n_seeded, row.n_windows, row.n_balanced) == (2, 2, 1, 12, sum(got.values()))
