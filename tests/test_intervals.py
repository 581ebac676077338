import random

import pytest
from pyspark.sql import functions as F

from lociweave.operators.graph import connected_components
from lociweave.operators.intervals import equal_copy_counts, islands, merged, range_join
from lociweave.operators.ranking import gapless_index


def brute_islands(rows, touching):
    out, last, island = [], None, 0
    for s, e in sorted(rows):
        if last is None or (s > last if touching else s >= last):
            island += 1
        last = e if last is None else max(last, e)
        out.append((s, e, island))
    return sorted(out)


@pytest.mark.parametrize("touching", [False, True])
@pytest.mark.parametrize("bin_size", [None, 7])
def test_islands_equal_a_sweep(spark, touching, bin_size):
    rng = random.Random(5)
    rows = [(k, s, s + rng.randint(0, 6)) for k in ("a", None) for s in (rng.randint(-40, 60) for _ in range(60))]
    df = spark.createDataFrame(rows, "k string, s long, e long")
    got = islands(df, ["k"], "s", "e", touching, "i", bin_size).collect()
    for k in ("a", None):
        want = brute_islands([(s, e) for kk, s, e in rows if kk == k], touching)
        assert sorted((r.s, r.e, r.i) for r in got if r.k == k) == want


def test_touching_intervals(spark):
    df = spark.createDataFrame([("k", 0, 10), ("k", 10, 20)], "k string, s long, e long")
    assert merged(df, ["k"], "s", "e", touching=False).count() == 2
    assert merged(df, ["k"], "s", "e", touching=True).count() == 1
    assert merged(df.limit(0), ["k"], "s", "e").count() == 0


@pytest.mark.parametrize("contained", [False, True])
def test_range_join_equals_all_pairs(spark, contained):
    rng = random.Random(9)
    make = lambda n: [(rng.choice("xy"), i, s, s + rng.randint(0, 25)) for i in range(n) for s in [rng.randint(0, 90)]]
    a, b = make(40), make(30)
    left, right = spark.createDataFrame(a, "k string, i long, s long, e long"), spark.createDataFrame(b, "k string, j long, u long, v long")
    got = {(r.i, r.j) for r in range_join(left, right, ["k"], 10, ("s", "e"), ("u", "v"), contained).collect()}
    meets = lambda s, e, u, v: s < e and u < v and ((s >= u and e <= v) if contained else (s < v and u < e))
    assert got == {(i, j) for k, i, s, e in a for m, j, u, v in b if k == m and meets(s, e, u, v)}


def test_equal_copy_counts(spark):
    rows = spark.createDataFrame([("g", "a", "+", 0, 5), ("g", "b", "+", 9, 12), ("h", "a", "+", 0, 5), ("h", "a", "-", 3, 6)], "g string, x string, st string, s long, e long")
    items = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "a"), ("h", "b"), ("n", "a")], "g string, x string")
    assert {r.g: r.balanced for r in equal_copy_counts(rows, ["g"], items, "x", "st", "s", "e").collect()} == {"g": True, "h": False, "n": False}


def test_components_equal_a_search(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 90), rng.randint(0, 90)) for _ in range(70)] + [(200, 200 + i) for i in range(40)] + [(300 + i, 301 + i) for i in range(30)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    near = {}
    for a, b in edges:
        if a is not None:
            near.setdefault(a, {a}).add(b)
            near.setdefault(b, {b}).add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for n in near[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        assert got[node] == min(seen)
    assert set(got) == set(near)
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_gapless_index(spark):
    rows = [(g, i % 7, i) for i in range(100) for g in ([None, "a", "b"][i % 3],)] + [("hot", 1, i) for i in range(300)]
    got = gapless_index(spark.createDataFrame(rows, "g string, o long, i long"), ["g"], ["o"], "n").collect()
    for g in (None, "a", "b", "hot"):
        own = sorted((r.n, r.o) for r in got if r.g == g)
        assert [n for n, _ in own] == list(range(len(own))) and [o for _, o in own] == sorted(o for _, o in own)


def test_scalars(spark):
    from lociweave.functions import scalars as S

    one = spark.range(1)
    assert one.select(S.strip_version(F.lit("ENST1.12"))).first()[0] == "ENST1"
    assert one.select(S.reverse_complement(F.lit("acgtN-R"))).first()[0] == "Y-Nacgt"
    attrs = one.select(S.attributes(F.lit('ID=exon:1.1:8; a=b=c ;exon_number 8; name "x y"; a=2')).alias("a")).first().a
    assert attrs == {"ID": "exon:1.1:8", "a": "2", "exon_number": "8", "name": "x y"}
    score = lambda n, i: one.select(S.exon_score(F.lit(n), F.lit(i))).first()[0]
    assert score(100, 100) == 100 and score(100, 95) == 80 and score(0, 5) == 0 and score(10, 0) == -300
    for length, want in ((149, 1), (150, 0), (151, 0), (100, 25)):
        left, right = S.anchor_lengths(F.lit(1000), F.lit(1000 + length), F.lit(5000))
        assert tuple(one.select(left, right).first()) == (want, want)
    left, right = S.anchor_lengths(F.lit(3), F.lit(103), F.lit(110))
    assert tuple(one.select(left, right).first()) == (3, 7)
    assert one.select(S.window_padding(F.lit(1001)), S.gap_limit(F.lit(1001))).first()[:] == (1502, 1501)
    assert S.parse_region("chr1:2,000-1,000/rc") == ("chr1", 1000, 2000)
    assert tuple(one.select(*S.query_location(F.lit("chr1_5_9"))).first()) == ("chr1", 5)
    assert one.select(S.cigar_length(F.lit("2=1I4=10S"), "=I")).first()[0] == 7
    assert one.select(S.bed_score(F.array(F.lit(0.0005), F.lit(0.0025)))).first()[0] == 2


def test_binned_islands_of_equal_intervals_stay_together(spark):
    import random

    from pyspark.sql import functions as F

    from lociweave.operators.intervals import islands

    rng = random.Random(17)
    places = [(g, s, s + rng.choice([0, 3, 7])) for g in "ab" for s in (rng.randrange(400) for _ in range(60))]
    rows = [(i, *p) for i, p in enumerate(places * 9)]
    df = spark.createDataFrame(rows, "i long, g string, s long, e long").repartition(7, "i")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for touching in (False, True):
            real = df.where("e > s")
            made = islands(real, ["g"], "s", "e", touching, bin_size=50).select("i", F.col("island").alias("b"))
            met = islands(real, ["g"], "s", "e", touching).join(made, "i")
            assert met.where("island <> b").count() == 0 and met.count() == sum(e > s for _, _, s, e in rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
