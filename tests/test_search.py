import pytest

from lociweave.plans import exon_database as D
from lociweave.plans import search as S
from lociweave.streaming.sessions import session_counts


def hsp(q, s, qstart, qend, sstart, send, score=0.0):
    return {"qseq": q, "sseq": s, "qstart": qstart, "qend": qend, "sstart": sstart, "send": send, "score": score}


def test_projection_through_a_gap_in_either_direction():
    q, s = "AACCGG-TTAACC", "AACCGGATTAACT"
    for start, end, want in ((101, 113, (104, 111)), (113, 101, (102, 109))):
        row = S.project(hsp(q, s, 1, 12, start, end), 4, 10)
        assert (row["target_start"], row["target_end"]) == want
        assert (row["exon_start"], row["exon_end"], row["cigar"], row["identical"], row["NM"], row["AS"]) == (0, 6, "2=1I4=", 6, 1, 3.0)
        assert S.project(hsp(q, s, 1, 12, start, end), 2, 12)["blast_score"] == 4.0
    flip = str.maketrans("ACGT-", "TGCA-")
    back = S.project(hsp(q.translate(flip)[::-1], s.translate(flip)[::-1], 12, 1, 201, 213), 4, 10)
    assert (back["target_start"], back["target_end"], back["cigar"]) == (202, 209, "4=1I2=")


def test_projection_scores_ambiguity_codes_and_edges():
    assert S.project(hsp("AANRYYC", "AAARRAC", 1, 7, 1, 7), 0, 7)["blast_score"] == -3.0
    assert S.project(hsp("ACGT", "ACGT", 1, 4, 1, 4), 4, 8) is None
    assert S.project(hsp("AACC", "--CC", 1, 4, 1, 2), 0, 2) is None
    with pytest.raises(ValueError):
        S.project(hsp("ACGT", "ACG", 1, 4, 1, 4), 0, 4)


def test_projected_rows(spark):
    hsps = spark.createDataFrame([(1, "Q", "c", 81, 160, 1001, 1080, 1e-9, 80.0, "ACGT" * 20, "ACGT" * 20)],
        "ord long, qseqid string, sseqid string, qstart long, qend long, sstart long, send long, evalue double, score double, qseq string, sseq string")
    aliases = spark.createDataFrame([("Q", "LONG", 60, 240, 40, 260), ("Q", "SHORT", 100, 140, 80, 160)],
        "query_id string, exon_id string, core_start long, core_end long, anchor_start long, anchor_end long")
    got = {r.exon_id: r for r in S.projected(hsps.unionByName(hsps), aliases).collect()}
    assert got["SHORT"].coverage == 100 and (got["SHORT"].target_start, got["SHORT"].target_end) == (1020, 1060) and got["SHORT"].selection_score == 80
    assert got["LONG"].coverage < 90 and len(got) == 2


def test_windows(spark):
    seeds = spark.createDataFrame([("q", "c", 10000, 200, 1300), ("q", "c", 10000, 9000, 9100)], "query string, contig string, contig_length long, start long, end long")
    genes, of = spark.createDataFrame([("g", 1001)], "gene string, span long"), spark.createDataFrame([("q", "g")], "query string, gene string")
    assert sorted((r.window_start, r.window_end) for r in S.seed_windows(seeds, genes, of).collect()) == [(0, 2802), (7498, 10000)]


def test_kmers_equal_a_scan(spark):
    texts = [(i, ("abcde" * 300 + "é" * i + "xyzuvw" * 9)[i:]) for i in range(6)]
    df = spark.createDataFrame(texts, "id long, text string")
    got = {(r.q, r.query_at, r.id, r.target_at) for r in S.shared_kmers(df.limit(2).withColumnRenamed("id", "q"), "q", df, "id", "text", 40, 500).collect()}
    first = dict(texts)
    want = {
        (q, a, i, b)
        for q in {g[0] for g in got}
        for a in range(0, len(first[q]) - 39, 500)
        for i, t in texts
        for b in range(len(t) - 39)
        if t[b : b + 40] == first[q][a : a + 40]
    }
    assert got == want and len({(q, i, b) for q, _, i, b in want}) < len(want)


def exon(i, start, end, gene="G", strand="+"):
    return (i, f"E{i}", f"E{i}", "c", start, end, strand, f"T{i}", 1, gene, gene, "protein_coding", i == 1)


EXONS = "ord long, exon_id_full string, exon_id string, chrom string, start0 long, end0 long, strand string, tid string, exon_number int, gene_id string, gene_name string, transcript_type string, own_mane boolean"


@pytest.mark.parametrize("strand", ["+", "-"])
def test_union_queries_hold_every_exon(spark, strand):
    import random

    rng = random.Random(1)
    contig = "".join(rng.choice("ACGT") for _ in range(4000))
    genome = spark.createDataFrame([("c", contig)], "name string, seq string")
    spans = [(500, 600), (550, 700), (690, 900), (900, 1000), (2000, 2300)]
    rows = spark.createDataFrame([exon(i, s, e, strand=strand) for i, (s, e) in enumerate(spans, 1)], EXONS)
    exons = D.anchored(D.collapse_exons(rows), genome)
    aliases = D.union_queries(exons)
    text = {r.query_id: r.sequence for r in D.query_sequences(aliases, genome).collect()}
    got = aliases.collect()
    assert len(text) == 3 and len(got) == 5
    for r in got:
        assert text[r.query_id][r.anchor_start : r.anchor_end] == r.sequence
        assert r.core_end - r.core_start == r.end0 - r.start0


def test_collapse_and_sequence_groups(spark):
    rows = [exon(1, 0, 200), exon(2, 0, 200), exon(3, 1000, 1200)]
    rows[1] = (2, "E1", "E1", *rows[1][3:])
    genome = spark.createDataFrame([("c", ("ACGTTGCA" * 25 + "N" * 800) * 2)], "name string, seq string")
    collapsed = D.collapse_exons(spark.createDataFrame(rows, EXONS))
    first = collapsed.where("exon_id = 'E1'").first()
    assert first.transcript_ids == ["T1", "T2"] and first.any_mane and first.coding and collapsed.count() == 2
    grouped = D.sequence_groups(D.anchored(collapsed, genome)).collect()
    assert {r.representative for r in grouped} == {"E1"}
    assert D.anchored(collapsed, genome, least_unmasked=500).count() == 0


def test_identical_paralogs(spark):
    genome = spark.createDataFrame([("c", "AACCGGTTAC" * 3 + "AACCGGTTAC" * 3)], "name string, seq string")
    rows = [exon(1, 0, 10, "GA"), exon(2, 30, 40, "GB"), exon(3, 1, 11, "GC")]
    mane = spark.createDataFrame([("GA", "T1"), ("GB", "T2"), ("GC", "T3")], "gene_id string, tid string")
    got = D.identical_paralogs(spark.createDataFrame(rows, EXONS), mane, genome).collect()
    assert [(r.representative_gene_id, r.gene_ids, r.merged_gene_name) for r in got] == [("GA", "GA;GB", "GAmerged")]
    fasta = D.fasta_text(spark.createDataFrame([("x", "A" * 170)], "query_id string, sequence string")).first()[0]
    assert [len(x) for x in fasta.split("\n")] == [2, 80, 80, 10]


def test_session_stream(spark, tmp_path):
    spark.sql("SELECT 1L AS user_id, timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 20 * id) AS ts FROM range(4)").write.parquet(str(tmp_path / "in"))
    rows = spark.readStream.schema("user_id long, ts timestamp").parquet(str(tmp_path / "in"))
    query = session_counts(rows, "user_id", "ts").writeStream.outputMode("complete").format("memory").queryName("sessions").start()
    query.processAllAvailable()
    query.stop()
    assert [r.n_events for r in spark.table("sessions").collect()] == [4]


def test_alignments_are_given_to_aliases(spark):
    from lociweave.plans.search import with_aliases

    exons = spark.createDataFrame([("r", "c1", 100, 200, "+"), ("m", "c1", 100, 200, "-")], "exon_id string, chrom string, start long, end long, strand string")
    aliases = spark.createDataFrame(
        [("r", "inside", "c1", 120, 140, "+", 20, "overlap"), ("r", "turned", "c1", 120, 140, "-", 20, "overlap"), ("r", "away", "c2", 5, 55, "-", 50, "exact_sequence"),
         ("r", "outside", "c1", 190, 200, "+", 10, "overlap"), ("m", "far", "c1", 100, 105, "-", 5, "overlap"), ("lost", "x", "c1", 0, 9, "+", 9, "overlap")],
        "representative_id string, exon_id string, chrom string, start long, end long, strand string, length long, merge_reason string",
    )
    rows = spark.createDataFrame([(1, "r", "+", 10, 60, 50, 45), (2, "m", "-", 0, 50, 50, 50), (3, "lost", "+", 0, 9, 9, 9), (4, "none", "+", 1, 2, 1, 1)],
                                 "ord long, exon_id string, strand string, exon_start long, exon_end long, bases long, identical long")
    got = {tuple(r) for r in with_aliases(rows, exons, aliases).drop("coverage").collect()}
    assert got == {
        (1, "inside", "+", 0, 20, 20, 18, 20), (1, "turned", "-", 0, 20, 20, 18, 20), (1, "away", "+", 10, 50, 40, 36, 50),
        (2, "m", "-", 0, 50, 50, 50, None), (3, "lost", "+", 0, 9, 9, 9, None), (4, "none", "+", 1, 2, 1, 1, None),
    }
