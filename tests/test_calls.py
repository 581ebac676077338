import itertools
import random

import pytest
from pyspark.sql import functions as F

from lociweave.operators import chains
from lociweave.plans import annotation as A
from lociweave.plans import calls as C
from lociweave.plans import reports
from lociweave.plans.evidence import non_overlapping
from lociweave.sources import readers as R


def hit(number, start, end, score=100.0, exon=None, block=None, length=None):
    b = block or (start, end)
    return {"number": number, "exon_id": exon or f"E{number}", "start": start, "end": end, "block_start": b[0], "block_end": b[1], "score": score,
            "length": length or end - start, "exon_score": score, "bases": end - start}


def brute_transcript(hits, strand):
    place = lambda h: (h["start"], h["end"]) if strand == "+" else (-h["end"], -h["start"])

    def linked(p, h):
        if p["number"] >= h["number"] or place(p)[1] > place(h)[0]:
            return False
        lo, hi = place(p)[1], place(h)[0]
        return not any(x["number"] in (p["number"], h["number"]) and place(x)[0] >= lo and place(x)[1] <= hi for x in hits if x is not p and x is not h)

    best = (-1e9, 0)
    for n in range(1, len(hits) + 1):
        for own in itertools.permutations(hits, n) if n <= 1 else itertools.combinations(sorted(hits, key=place), n):
            if all(linked(a, b) for a, b in zip(own, own[1:], strict=False)):
                gain = sum(h["score"] for i, h in enumerate(own) if i == 0 or (h["block_start"], h["block_end"]) != (own[i - 1]["block_start"], own[i - 1]["block_end"]))
                best = max(best, (round(gain, 6), n))
    return best


@pytest.mark.parametrize("strand", ["+", "-"])
def test_transcript_chain_is_optimal(strand):
    rng = random.Random(3)
    for _ in range(60):
        at, hits = 0, []
        for _ in range(rng.randint(1, 7)):
            at += rng.randint(5, 30)
            hits.append(hit(rng.randint(1, 4), at, at + 4, float(rng.randint(1, 9))))
        found = chains.transcript_chain(hits, list(range(len(hits))), strand, chains.barriers(hits, strand))
        assert (round(sum(hits[i]["score"] for i in found), 6), len(found)) == brute_transcript(hits, strand)


@pytest.mark.parametrize("strand", ["+", "-"])
def test_gene_chain_is_optimal(strand):
    rng = random.Random(4)
    for _ in range(60):
        hits = [hit(rng.randint(1, 5), 10 * i, 10 * i + 8, float(rng.choice([30, 60, 100, 150]))) for i in range(rng.randint(1, 7))]
        order = hits if strand == "+" else hits[::-1]
        best = (-1e9, 0, 0)
        for n in range(1, len(order) + 1):
            for places in itertools.combinations(range(len(order)), n):
                own = [order[i] for i in places]
                if any(a["number"] >= b["number"] for a, b in zip(own, own[1:], strict=False)):
                    continue
                cost = sum(len({order[k]["number"] for k in range(i + 1, j)}) for i, j in zip(places, places[1:], strict=False))
                best = max(best, (sum(h["score"] for h in own) - 50 * cost, n, -cost))
        found = chains.gene_chain(hits, list(range(len(hits))), strand, None)
        real = [i for i, inserted in found if not inserted]
        base = {"strand": strand, "expected": 9, "coding": False, "mane": False, "coding_x": 1.0, "complete_x": 1.0, "mane_x": 1.0}
        scored = chains.scored(base, [{**hits[i], "inserted": x} for i, x in found])
        assert (scored["raw"], len(real)) == best[:2]


def test_gene_chain_limits():
    far = [hit(1, 0, 10), hit(2, 1000, 1010)]
    assert len(chains.gene_chain(far, [0, 1], "+", 990)) == 2
    assert len(chains.gene_chain(far, [0, 1], "+", 989)) == 1
    wall = [hit(1, 0, 10), *[hit(50 + i, 20 * (i + 1), 20 * (i + 1) + 5) for i in range(21)], hit(2, 900, 910, 5000.0)]
    assert [i for i, x in chains.gene_chain(wall, [0, len(wall) - 1], "+", None) if not x] == [len(wall) - 1]


GFF = """##gff-version 3
chr1\tx\ttranscript\t1\t900\t.\t+\t.\tID=TA;gene_id=GA;transcript_id=TA;gene_name=NA;transcript_type=protein_coding;tag=MANE_Select
chr1\tx\ttranscript\t1\t900\t.\t+\t.\tID=TB;gene_id=GA;transcript_id=TB;gene_name=NA;transcript_type=protein_coding;tag=MANE_Select
chr1\tx\ttranscript\t1\t900\t.\t+\t.\tID=TN;gene_id=GA;transcript_id=TN;gene_name=NA;transcript_type=protein_coding
chr2\tx\ttranscript\t1\t900\t.\t+\t.\tID=TC;gene_id=GC;transcript_id=TC;gene_name=NC;transcript_type=protein_coding;tag=MANE_Select
"""


def exon_line(chrom, start, end, gene, tid, number, exon, strand="+", name=None):
    return f"{chrom}\tx\texon\t{start + 1}\t{end}\t.\t{strand}\t.\tgene_id={gene};transcript_id={tid};gene_name={name or 'N' + gene[1:]};transcript_type=protein_coding;exon_number={number};exon_id={exon}\n"


HEAD = "\t".join(n for n, _ in R.ALIGNMENT) + "\n"


def aligned(query, start, end, exon, strand="+"):
    n = end - start
    return f"{query}\t100.0\t{start}\t{end}\t{strand}\t{exon}\t{exon}.1\t{n}\t0\t{n}\t{n}\t100.0\t{n}\t{n}.0\t0\t0\t{n}=\t{query}\n"


@pytest.fixture(scope="module")
def micro(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("micro")
    text = GFF + "".join(exon_line("chr1", s, s + 100, "GA", t, n, e) for t in ("TA", "TB", "TN") for n, e, s in ((1, "E1", 100), (2, "E2", 300)))
    text += "".join(exon_line("chr2", s, s + 100, "GC", "TC", n, e) for n, e, s in ((1, "E3", 100), (2, "E4", 300)))
    (folder / "a.gff3").write_text(text)
    rows = "".join(aligned(q, s, s + 100, e) for q in ("sampleA", "sampleB") for s, pair in ((100, ("E1", "E3")), (300, ("E2", "E4"))) for e in pair)
    (folder / "a.tsv").write_text(HEAD + rows)
    return A.annotation(R.gff3(spark, str(folder / "a.gff3"))), R.alignments(spark, str(folder / "a.tsv"))


def test_tied_genes_and_their_isoforms_share_rows(micro):
    a, alignments = micro
    calls, models = C.call_genes(alignments, a)
    table = reports.call_table(calls).orderBy("row_order").collect()
    assert [(r.gene_id, r.transcript_id, r.tie_count) for r in table] == [("GA;GC", "GA;GC", "2"), ("GA;GC", "TA;TC", "2")] * 2
    assert len({r.GENE_index for r in table}) == 2 and {r.query_id for r in table} == {"sampleA", "sampleB"}
    assert table[0].query_id == "sampleB" and table[1].exon_query_coordinates == "100-200,300-400;100-200,300-400"
    assert all(r.assignment_status == "tied" and r.call_status == "complete" for r in table)
    assert models.count() == 4
    lines = reports.bed(reports.call_table(calls)).collect()
    assert len(lines) == 4 and lines[0].blockSizes == "100,100," and lines[0].score == 1000 and len(lines[0]) == 43


def test_flat_calls_and_the_legacy_table(micro):
    a, alignments = micro
    calls, models = C.call_genes(alignments.where("exon_id IN ('E1', 'E2')"), a, C.Options(two_stage=False))
    assert models is None and {r.tid for r in calls.collect()} == {"TA"}
    assert {r.similarity for r in reports.legacy_table(reports.call_table(calls)).collect()} == {"100.0"}


def test_fragments_and_empty_evidence(micro):
    a, alignments = micro
    calls, _ = C.call_genes(alignments.where("exon_id = 'E1' AND query_id = 'sampleA'"), a)
    assert calls.count() == 2 and all(r.is_fragment for r in calls.collect())
    none, _ = C.call_genes(alignments.limit(0), a)
    assert none.count() == 0 and reports.call_table(none).count() == 0


def test_genes_that_share_exons_are_one_unit(spark, tmp_path):
    text = "".join(exon_line("chr1", s, e, "GA", "TA", n, f"A{n}") for n, (s, e) in enumerate([(100, 180), (200, 260), (400, 460)], 1))
    text += "".join(exon_line("chr1", s, e, "GB", "TB", n, f"B{n}") for n, (s, e) in enumerate([(200, 260), (400, 460), (800, 920)], 1))
    (tmp_path / "a.gff3").write_text(text)
    a = A.annotation(R.gff3(spark, str(tmp_path / "a.gff3")))
    units = A.shared_exon_units(a.exons).collect()
    assert {(r.gene_id, r.unit_id, r.shared) for r in units} == {("GA", "GA&GB", 120), ("GB", "GA&GB", 120)}
    assert A.shared_exon_units(a.exons, threshold=120).count() == 0
    rows = "".join(aligned("q", s, e, x) for s, e, x in [(100, 180, "A1"), (200, 260, "A2"), (200, 260, "B1"), (400, 460, "A3"), (400, 460, "B2"), (800, 920, "B3")])
    (tmp_path / "a.tsv").write_text(HEAD + rows)
    calls, _ = C.call_genes(R.alignments(spark, str(tmp_path / "a.tsv")), a)
    found = {(r.tid, len(r.found), r.expected) for r in calls.collect()}
    # equal scores on shared blocks: the longer isoform goes first, the other has what is left
    assert found == {("GA&GB_full_gene", 4, 4), ("TB", 3, 3), ("TA", 1, 3)}


def test_greedy_choice_of_non_overlapping_rows(spark):
    rng = random.Random(8)
    rows = [(k, i, s, s + rng.randint(1, 15), rng.randint(0, 5)) for k in "ab" for i in range(40) for s in [rng.randint(0, 200)]]
    df = spark.createDataFrame(rows, "k string, i long, s long, e long, w long")
    got = {(r.k, r.i) for r in non_overlapping(df, ["k"], "s", "e", [-F.col("w")]).collect()}
    want = set()
    for k in "ab":
        kept = []
        for r in sorted((r for r in rows if r[0] == k), key=lambda r: (-r[4], r[2], r[3], r[1])):
            if all(r[3] <= x[2] or x[3] <= r[2] for x in kept):
                kept.append(r)
        want |= {(r[0], r[1]) for r in kept}
    assert got == want


def test_alignment_layouts_agree(spark, tmp_path):
    extended = aligned("q", 300, 100, "E1.2", "-").replace("\t-200\t", "\t200\t").replace("-200.0", "200.0")
    (tmp_path / "headed.tsv").write_text(HEAD + aligned("q", 100, 200, "E1"))
    (tmp_path / "bare.tsv").write_text(aligned("q", 100, 200, "E1"))
    (tmp_path / "spaces.txt").write_text(aligned("q", 100, 200, "E1").replace("\t", "  "))
    (tmp_path / "legacy.tsv").write_text("q\t100.0\t200\t100\t+\tE1\t100\t0\t100\t100\t100.0\t100.0\t100.0\n")
    keep = ["query_id", "query_start", "query_end", "strand", "exon_id", "exon_length", "identical_bases", "exon_coverage"]
    for name in ("headed.tsv", "bare.tsv", "spaces.txt", "legacy.tsv"):
        assert tuple(R.alignments(spark, str(tmp_path / name)).select(keep).first()) == ("q", 100, 200, "+", "E1", 100, 100, 100.0), name
    assert extended


def test_fasta_paf_sam(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">one first\nACGT\nacgt\n>two\nNN>N\n")
    got = {r.name: r.seq for r in R.fasta(spark, str(tmp_path / "a.fa")).collect()}
    assert got == {"one": "ACGTacgt", "two": "NN>N"}
    (tmp_path / "a.paf").write_text("q\t9\t0\t9\t+\tc\t100\t5\t14\t9\t9\t60\n")
    assert tuple(R.paf(spark, str(tmp_path / "a.paf")).first()) == ("q", "c", 100, 5, 14)
    (tmp_path / "b.paf").write_text("q\t9\t0\t9\t+\tc\t10\t5\t14\t9\t9\t60\n")
    with pytest.raises(Exception, match="malformed"):
        R.paf(spark, str(tmp_path / "b.paf")).collect()
    (tmp_path / "a.sam").write_text("@HD\nq\t16\tc\t11\t60\t3S10M2I5M1S\t*\t0\t0\t*\t*\tAS:i:12\tNM:i:2\nu\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*\n")
    row = R.sam(spark, str(tmp_path / "a.sam")).first()
    assert (row.strand, row.start, row.end, row.query_start, row.query_end, row.AS, row.NM) == ("-", 10, 25, 1, 18, 12.0, 2)


def test_barriers_of_a_table_equal_the_kernel(spark):
    from pyspark.sql import functions as F

    from lociweave.operators.barriers import may_follow, with_barriers

    rng = random.Random(21)
    rows = [(g, rng.randint(1, 4), *sorted((rng.randrange(60), rng.randrange(60)))) for g in (1, 2, None) for _ in range(40)]
    df = spark.createDataFrame(rows, "g long, number int, s long, e long")
    got = {(r["g"], r["number"], r["s"], r["e"]): (r["later_end"], r["earlier_start"]) for r in with_barriers(df, ["g"], "number", "s", "e").collect()}
    assert with_barriers(df, ["g"], "number", "s", "e").count() == len(rows)
    for g in (1, 2, None):
        own = [{"number": n, "start": s, "end": e} for k, n, s, e in rows if k == g]
        for i, (later, earlier) in chains.barriers(own, "+").items():
            finite = lambda x: None if x in (float("inf"), -float("inf")) else x
            assert got[g, own[i]["number"], own[i]["start"], own[i]["end"]] == (finite(later), finite(earlier))
    one, other = [[F.lit(v).cast("long") for v in x] for x in ((1, 0, 5, 9, None), (2, 9, 12, None, 4))]
    assert not spark.range(1).select(may_follow(one, other)).first()[0]


def plain_walls(hits, strand):
    place = lambda h: (h["start"], h["end"]) if strand == "+" else (-h["end"], -h["start"])
    out = {}
    for i, h in enumerate(hits):
        own = [place(x) for x in hits if x["number"] == h["number"]]
        out[i] = min((e for s, e in own if s >= place(h)[1]), default=float("inf")), max((s for s, e in own if e <= place(h)[0]), default=-float("inf"))
    return out


@pytest.mark.parametrize("strand", ["+", "-"])
def test_indexed_chains_equal_a_scan_of_all_hits(strand):
    """The best score and number of hits over every hit before, with later copies that are no longer free in the way."""
    rng = random.Random(22)
    place = lambda h: (h["start"], h["end"]) if strand == "+" else (-h["end"], -h["start"])
    for _ in range(300):
        blocks = [(30 * k, 30 * k + rng.randint(5, 30)) for k in range(8)]
        hits = []
        for _ in range(rng.randint(1, 25)):
            b = rng.choice(blocks)
            s = rng.randint(b[0], b[1] - 1)
            hits.append({"number": rng.randint(1, 6), "exon_id": "E", "start": s, "end": rng.randint(s + 1, b[1]), "block_start": b[0], "block_end": b[1], "score": 10.0 + b[0], "length": 1, "exon_score": 1.0, "bases": 1})
        walls = chains.barriers(hits, strand)
        assert walls == plain_walls(hits, strand)
        free = sorted(rng.sample(range(len(hits)), rng.randint(1, len(hits))))
        best = {}
        for h in sorted(free, key=lambda i: (*place(hits[i]), hits[i]["number"])):
            s = place(hits[h])[0]
            before = [p for p in best if hits[p]["number"] < hits[h]["number"] and place(hits[p])[1] <= s and walls[p][0] > s and walls[h][1] < place(hits[p])[1]]
            gain = lambda p, h=h: 0.0 if hits[p]["block_start"] == hits[h]["block_start"] else hits[h]["score"]
            best[h] = max([(hits[h]["score"], 1), *((best[p][0] + gain(p), best[p][1] + 1) for p in before)])
        found = chains.transcript_chain(hits, free, strand, walls)
        assert (sum({hits[i]["block_start"]: hits[i]["score"] for i in found}.values()), len(found)) == max(best.values())


def test_a_hundred_thousand_hits_chain_in_seconds():
    import time

    rng, at, hits = random.Random(23), 0, []
    for k in range(100_000):
        at += rng.randint(5, 60)
        hits.append({"number": k % 40 + 1, "exon_id": "E", "start": at, "end": at + 4, "block_start": at, "block_end": at + 4, "score": 50.0, "length": 4, "exon_score": 1.0, "bases": 4})
    for model in ("transcript", "full_gene"):
        began = time.time()
        (found,) = chains.chains_of(hits, "+", model, 1000, most=1)
        assert len({h["number"] for h in found}) == 40 and time.time() - began < 60
