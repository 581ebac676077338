"""FASTA by byte ranges against a plain reader, and searches over chunks and a stored index."""

import random
import re

import pytest

from lociweave.operators.minimisers import minimisers
from lociweave.operators.stretches import with_length, with_stretch
from lociweave.plans.seeding import minimiser_seeds, seeds_of_index, store_index
from lociweave.sources.fasta_ranges import fasta_chunks


def plain(text):
    out = []
    for line in text.split("\n"):
        if line.startswith(">"):
            out.append([line[1:].split()[0] if line[1:].split() else "", ""])
        else:
            out[-1][1] += "".join(line.split())
    return out


def genome(rng, ending="\n"):
    parts = []
    for k in range(rng.randint(1, 6)):
        bases = "".join(rng.choices("ACGTacgtN", k=rng.choice([0, 1, 30, 300, 2000])))
        width = rng.choice([7, 60, 10_000])
        parts.append(f">c{k} {'about ' * rng.randint(0, 20)}" + ending + ending.join(bases[i : i + width] for i in range(0, len(bases), width)) + ending * rng.randint(0, 2))
    return re.sub("(?<!\n)>", "\n>", "".join(parts)).lstrip("\n")


@pytest.mark.parametrize(("range_bytes", "size"), [(7, 5), (64, 50), (1000, 64), (1 << 20, 1 << 14)])
def test_ranges_of_any_size_give_the_contigs(spark, tmp_path, range_bytes, size):
    rng = random.Random(range_bytes)
    folder = tmp_path / "in"
    folder.mkdir()
    want = []
    for f in range(2):
        text = genome(rng, rng.choice(["\n", "\r\n"])).replace(">c", f">f{f}c")
        (folder / f"{f}.fa").write_bytes(text.encode())
        want += plain(text)
    chunks, contigs = fasta_chunks(spark, str(folder), size, range_bytes)
    assert [(r["ordinal"], r["contig"], r["length"]) for r in contigs.orderBy("ordinal").collect()] == [(i, n, len(s)) for i, (n, s) in enumerate(want)]
    got = {}
    for r in sorted(chunks.collect(), key=lambda r: (r["contig"], r["chunk"])):
        assert len(r["piece"]) <= size and r["chunk"] * size == len(got.get(r["contig"], ""))
        got[r["contig"]] = got.get(r["contig"], "") + r["piece"]
    assert got == dict(want)


def test_bad_files_are_errors(spark, tmp_path):
    for text, words in ((">a\nAC\n>a b\nGT\n", "repeated"), (">a\nAC\n>\nGT\n", "empty")):
        (tmp_path / "x.fa").write_text(text)
        with pytest.raises(ValueError, match=words):
            fasta_chunks(spark, str(tmp_path / "x.fa"))
    (tmp_path / "x.fa").write_text("AC\n>a\nGT\n")
    with pytest.raises(Exception, match="before the first header"):
        fasta_chunks(spark, str(tmp_path / "x.fa"))


def test_chunks_serve_as_a_genome(spark, tmp_path):
    rng = random.Random(3)
    bases = {f"c{k}": "".join(rng.choices("ACGT", k=rng.choice([90, 5000, 40_000]))) for k in range(4)}
    (tmp_path / "g.fa").write_text("".join(f">{n}\n{s}\n" for n, s in bases.items()))
    chunks, _ = fasta_chunks(spark, str(tmp_path / "g.fa"), range_bytes=1000)
    frame = spark.createDataFrame(list(bases.items()), "contig string, seq string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(minimisers(chunks, "contig", "piece", 15, 5)) == rows(minimisers(frame, "contig", "seq", 15, 5))
    places = spark.createDataFrame([(n, 10, min(len(s), 20_000)) for n, s in bases.items()], "contig string, a long, b long")
    cut = with_stretch(with_length(places, chunks, "contig"), chunks, "contig", "a", "b", "s")
    assert {(r["contig"], r["s"]) for r in cut.collect()} == {(n, s[10:20_000]) for n, s in bases.items()}


def test_a_stored_index_is_not_shuffled(spark):
    rng = random.Random(4)
    bases = [(k, "".join(rng.choices("ACGT", k=3000))) for k in range(5)]
    targets = spark.createDataFrame(bases, "t long, s string")
    queries = spark.createDataFrame([(9, bases[2][1][500:900]), (8, bases[4][1][:200])], "q long, s string")
    store_index(targets, "t", "s", "seed_index_test", 15, 5, buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seeds, repeats = seeds_of_index(queries, "q", "s", spark.table("seed_index_test"), "t", 15, 5)
        want, _ = minimiser_seeds(queries, "q", targets, "t", "s", 15, 5)
        assert sorted(map(tuple, seeds.collect())) == sorted(map(tuple, want.collect())) != [] and repeats.count() == 0
        plan = seeds._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        index = plan[plan.index("seed_index_test") - 400 :].split("FileScan")[0]
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan and index.count("Exchange") == 0
        above = re.findall(r"^(.*)Exchange hashpartitioning\(code", plan, re.MULTILINE)
        assert len(above) <= 2  # the queries' side and the repeats alone
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE seed_index_test")
