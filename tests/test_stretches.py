import random

import pytest
from pyspark.sql import functions as F

from lociweave.operators import stretches
from lociweave.plans import search


@pytest.fixture(scope="module")
def genome(spark):
    rng = random.Random(5)
    texts = {name: "".join(rng.choices("ACGTacgtNé", k=n)) for name, n in (("a", 0), ("b", 1), ("c", 64), ("d", 65), ("e", 1000))}
    return texts, spark.createDataFrame(list(texts.items()), "name string, seq string")


@pytest.mark.parametrize("size", [1, 16, 64, 4096])
def test_stretches_equal_slices(spark, genome, size):
    texts, table = genome
    rng = random.Random(size)
    places = [(i, n, *sorted(rng.choices(range(-5, len(t) + 9), k=2))) for i, (n, t) in enumerate(list(texts.items()) * 40)]
    places += [(900, "d", 64, 64), (901, "c", 64, 64), (902, "e", 9, 3), (903, "nowhere", 0, 5), (904, "e", None, 5), (905, "e", 10, 20), (906, "e", 10, 20)]
    rows = spark.createDataFrame(places, "id int, contig string, start long, end long")
    got = stretches.with_stretch(stretches.with_length(rows, table, "contig"), table, "contig", "start", "end", "s", size)
    want = {i: texts[n][max(0, a) : max(0, b)] for i, n, a, b in places if n in texts and a is not None}
    assert {r.id: r.s for r in got.collect()} == want


def test_long_contigs_are_cut_in_steps(spark, monkeypatch):
    monkeypatch.setattr(stretches, "STEPS", (64, 32))
    text = "".join(random.Random(6).choices("ACGT", k=1000))
    got = stretches.chunks(spark.createDataFrame([("x", text)], "name string, seq string"), 8).collect()
    assert {r.chunk: r.piece for r in got} == {i: text[8 * i : 8 * i + 8] for i in range(125)}


def test_windows_inside_and_outside_their_contig(spark, genome):
    texts, table = genome
    rows = spark.createDataFrame([("g", "e", 0, 1000), ("h", "e", 5, 9), ("i", "nowhere", 0, 4)], "gene string, contig string, window_start long, window_end long")
    got = {r.gene: r.sequence for r in search.window_sequences(rows, table).collect()}
    assert got == {"g": texts["e"], "h": texts["e"][5:9]}
    for low, high in ((-1, 4), (0, 1001), (9, 5)):
        bad = spark.createDataFrame([("g", "e", low, high)], rows.schema)
        with pytest.raises(Exception, match="outside its contig"):
            search.window_sequences(bad, table).agg(F.count("sequence")).collect()
