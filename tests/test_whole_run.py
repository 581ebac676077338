"""From files to call tables: genes of a small genome found again on samples that differ from it."""

import random

import pytest

from lociweave.plans.whole_run import Search, annotate_samples

BACK = str.maketrans("ACGT", "TGCA")
EXONS = {"GA": [(1000, 1200), (1500, 1700), (2100, 2350)], "GB": [(6000, 6300), (6800, 7000)]}


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    rng = random.Random(41)
    dna = lambda n: "".join(rng.choices("ACGT", k=n))
    genome = dna(10_000)
    lines = ["##gff-version 3"]
    for gene, exons in EXONS.items():
        strand = "+" if gene == "GA" else "-"
        about = f"gene_id={gene}.1;transcript_id=T{gene}.1;gene_name={gene};transcript_type=protein_coding;tag=MANE_Select"
        lines.append("\t".join(["chr1", "x", "transcript", str(exons[0][0] + 1), str(exons[-1][1]), ".", strand, ".", f"ID=T{gene}.1;{about}"]))
        for n, (s, e) in enumerate(exons if strand == "+" else exons[::-1], 1):
            lines.append("\t".join(["chr1", "x", "exon", str(s + 1), str(e), ".", strand, ".", f"ID=e{n};exon_id=E{gene}{n}.1;exon_number={n};{about}"]))
    (folder / "a.gff3").write_text("\n".join(lines) + "\n")
    (folder / "g.fa").write_text(f">chr1\n{genome}\n")
    near = list(genome)
    for at in range(50, len(near), 97):  # about one base in a hundred differs
        near[at] = rng.choice([b for b in "ACGT" if b != near[at]])
    near = "".join(near)
    # sample one: both genes where they were, and a copy of GA turned round; sample two: GB alone, with three bases less in an exon
    one = near + dna(3000) + genome[900:2400].translate(BACK)[::-1] + dna(500)
    two = dna(2000) + genome[5900:6100] + genome[6103:7100] + dna(1000)
    (folder / "one.fa").write_text(f">c1 first\n{one}\n")
    (folder / "two.fa").write_text(">c1\n" + "\n".join(two[i : i + 60] for i in range(0, len(two), 60)) + "\n")
    # sample three: GA with an exon in which every fifteenth base differs, so that no word of fifteen is left of it
    worn = list(genome[500:3000])
    for at in range(1000, 1200, 15):
        worn[at] = "ACGT"[("ACGT".index(worn[at]) + 1) % 4]
    (folder / "three.fa").write_text(f">c1\n{''.join(worn)}\n")
    return folder


def test_genes_are_found_on_every_sample(spark, files):
    samples = spark.createDataFrame([("one", str(files / "one.fa")), ("two", str(files / "two.fa"))], "name string, fasta string")
    table = annotate_samples(spark, str(files / "a.gff3"), str(files / "g.fa"), samples, str(files / "out"))
    rows = [r.asDict() for r in table.collect()]
    transcripts = {(r["sample"], r["query_contig"], r["gene_name"], r["strand"], r["query_start"], r["query_end"], r["call_status"]) for r in rows if r["model_type"] != "full_gene"}
    assert transcripts == {
        ("one", "c1", "GA", "+", "1000", "2350", "complete"), ("one", "c1", "GB", "-", "6000", "7000", "complete"),
        ("one", "c1", "GA", "-", str(13_000 + 2400 - 2350), str(13_000 + 2400 - 1000), "complete"), ("two", "c1", "GB", "-", "2100", "3097", "complete"),
    }
    written = spark.read.csv(str(files / "out" / "calls"), sep="\t", header=True)
    assert written.groupBy("sample").count().count() == 2 and written.count() == sum(not r["is_fragment"] for r in rows)


@pytest.mark.parametrize("local_k", [11, 0])
def test_worn_exons_are_found_in_the_windows_of_their_gene(spark, files, local_k):
    samples = spark.createDataFrame([("three", str(files / "three.fa"))], "name string, fasta string")
    table = annotate_samples(spark, str(files / "a.gff3"), str(files / "g.fa"), samples, search=Search(local_k=local_k, least_identity=90.0))
    (row,) = [r for r in table.collect() if r["model_type"] != "full_gene"]
    assert (row["query_start"], row["query_end"]) == ("500", "1850") and row["call_status"] == ("complete" if local_k else "partial")


def test_options_are_checked():
    for bad in ({"k": 32}, {"w": 0}, {"band": -1}, {"least_identity": 101.0}):
        with pytest.raises(ValueError, match="is|are"):
            Search(**bad)
