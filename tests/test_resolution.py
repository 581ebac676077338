"""Competition for blocks: the kernel against a plain walk, and rounds of joins against the kernel."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lociweave.operators import chains
from lociweave.plans import calls as C
from lociweave.plans.resolution import resolved_in_rounds, tie_components, with_rank
from lociweave.storage import written

HIT = "struct<number: int, exon_id: string, start: long, end: long, block_start: long, block_end: long, score: double, inserted: boolean, at: int>"
CALL = (
    "_id long, query_id string, strand string, tid string, transcript_id_full string, gene string, gene_id_full string, mane boolean, coding boolean, exon_length long, expected int, "
    f"coding_x double, complete_x double, mane_x double, hits array<{HIT}>, raw double, weighted double, found array<int>, runs array<int>"
)
BLOCK = lambda h: (h["block_start"], h["block_end"])


def random_calls(rng, n, query="q", inserted=False, first=0):
    """Calls over a few blocks, with many equal scores and isoforms of one gene."""
    scores = {}
    out = []
    for k in range(n):
        gene = rng.choice("ABCD")
        hits, at = [], rng.randrange(14)
        for number in range(1, rng.randint(1, 5) + 1):
            score = scores.setdefault((gene, at), rng.choice([50.0, 50.0, 100.0, 100.0 / 3, 75.5]))
            hits.append({"number": number, "exon_id": f"E{number}", "start": 10 * at, "end": 10 * at + 9, "block_start": 10 * at, "block_end": 10 * at + 9, "score": score,
                         "inserted": inserted and 1 < number < 4 and rng.random() < 0.4, "at": len(hits)})
            at += rng.randint(1, 2)
        if hits[-1]["inserted"]:
            hits[-1]["inserted"] = False
        call = {"_id": first + k, "query_id": query, "strand": "+", "tid": f"T{k:03d}", "transcript_id_full": f"T{k:03d}.1", "gene": gene, "gene_id_full": gene + ".1", "mane": rng.random() < 0.2, "coding": rng.random() < 0.5,
                "exon_length": rng.choice([100, 200]), "expected": rng.choice([len(hits), 3]), "coding_x": 10.0, "complete_x": 2.0, "mane_x": 1.0}
        out.append(chains.scored(call, hits))
    return out


def plain(calls, prefer_mane):
    """Everything is scored anew before every choice; all calls of the best rank are decided together."""
    live, out = [dict(c) for c in calls], []
    while live:
        rank = lambda c: (prefer_mane and c["mane"], c["weighted"])
        top = max(live, key=rank)
        batch = [c for c in live if rank(c)[0] == rank(top)[0] and math.isclose(c["weighted"], top["weighted"], rel_tol=1e-12)]

        def parts(members):
            groups = []
            for c in members:
                own = {BLOCK(h) for h in c["hits"]}
                met = [g for g in groups if g[0] & own]
                groups = [g for g in groups if not g[0] & own] + [(own.union(*[g[0] for g in met]), [c] + [x for g in met for x in g[1]])]
            return [g[1] for g in groups]

        kept = []
        for members in parts(batch):
            for gene in {c["gene"] for c in members}:
                kept.append(min((c for c in members if c["gene"] == gene), key=lambda c: (-c["exon_length"], c["tid"])))
        for members in parts(kept):
            out += [(c["_id"], tuple(h["at"] for h in c["hits"]), round(c["weighted"], 6), len(members)) for c in members]
        gone = {BLOCK(h) for c in kept for h in c["hits"]}
        again = []
        for c in live:
            if any(c is k for k in kept):
                continue
            rest = [h for h in c["hits"] if BLOCK(h) not in gone]
            if any(not h["inserted"] for h in rest):
                again.append(chains.scored(c, rest) if len(rest) < len(c["hits"]) else c)
        live = again
    return sorted(out)


def shown(calls):
    return sorted((c["_id"], tuple(h["at"] for h in c["hits"]), round(c["weighted"], 6), c["tie_count"]) for c in calls)


@pytest.mark.parametrize("inserted", [False, True])
@pytest.mark.parametrize("prefer_mane", [False, True])
def test_the_kernel_equals_a_plain_walk(inserted, prefer_mane):
    rng = random.Random(31)
    for _ in range(400):
        calls = random_calls(rng, rng.randint(1, 14), inserted=inserted)
        assert shown(chains.resolve([dict(c) for c in calls], prefer_mane)) == plain(calls, prefer_mane)


@pytest.mark.parametrize("prefer_mane", [False, True])
def test_rounds_equal_the_kernel(spark, prefer_mane):
    rng = random.Random(32)
    groups = [random_calls(rng, rng.randint(1, 16), f"q{g}", first=100 * g) for g in range(12)]
    df = spark.createDataFrame([c for g in groups for c in g], CALL).repartition(3)
    got = resolved_in_rounds(df, prefer_mane, ["query_id", "strand"]).select("_id", "hits.at", "weighted", "tie_count", "found", "raw").collect()
    want = [c for g in groups for c in chains.resolve([dict(c) for c in g], prefer_mane)]
    assert sorted((r["_id"], tuple(r["at"]), round(r["weighted"], 6), r["tie_count"]) for r in got) == shown(want)
    assert {(r["_id"], tuple(r["found"]), r["raw"]) for r in got} == {(c["_id"], tuple(c["found"]), c["raw"]) for c in want}


def test_crowded_islands_are_resolved_alike(spark):
    rng = random.Random(33)
    calls = [c for g in range(4) for c in random_calls(rng, 12, f"q{g}", first=100 * g, inserted=g == 3)]
    full = spark.createDataFrame(calls, CALL).drop("_id").withColumns({"parent": F.lit(None).cast("string")})
    rows = lambda most: sorted(
        (r["query_id"], r["tid"], tuple(h["at"] for h in r["hits"]), r["raw"], r["tie_group_id"], r["tie_count"]) for r in C.resolved(full, True, most_at_once=most).collect()
    )
    assert rows(1) == rows(5000) and any(r[4] for r in rows(1))


def test_ties_by_rank_and_block(spark):
    calls = spark.createDataFrame([(1, "q", 5.0), (2, "q", 5.0 * (1 + 1e-14)), (3, "q", 5.0), (4, "q", 4.0), (5, None, 5.0), (6, None, 5.0), (7, "q", -5.0)], "_id long, k string, score double")
    blocks = spark.createDataFrame([(1, "q", 0, 9), (2, "q", 0, 9), (2, "q", 20, 29), (3, "q", 20, 29), (4, "q", 0, 9), (5, None, 0, 9), (6, None, 0, 9), (7, "q", 50, 59)], "_id long, k string, block_start long, block_end long")
    ranked = with_rank(calls, ["k"], F.lit(False), "score")
    got = {r["_id"]: (r["component"], r["tie_count"]) for r in tie_components(ranked, blocks, ["k"]).collect()}
    assert got == {1: (1, 3), 2: (1, 3), 3: (1, 3), 4: (4, 1), 5: (5, 2), 6: (5, 2), 7: (7, 1)}


def test_no_calls(spark):
    assert resolved_in_rounds(spark.createDataFrame([], CALL), True, ["query_id", "strand"]).count() == 0


def test_small_and_large_keys_are_resolved_alike(spark, monkeypatch):
    rng = random.Random(105)
    groups = [random_calls(rng, n, f"q{g}", first=100 * g, inserted=g % 2 == 1) for g, n in enumerate((1, 3, 6, 12))]
    idle = {**groups[0][0], "tid": "without", "hits": []}
    full = spark.createDataFrame([c for g in groups for c in g] + [idle], CALL).drop("_id").withColumn("parent", F.when(F.col("query_id") != "q3", F.col("query_id"))).repartition(3)
    keys = ("parent", "query_id", "strand")
    rows = lambda most: sorted(
        (r["query_id"], r["tid"], tuple(h["at"] for h in r["hits"]), round(r["weighted"], 6), r["tie_group_id"], r["tie_count"]) for r in C.resolved(full, True, keys, most_at_once=most).collect()
    )
    want = [c for g in groups for c in chains.resolve([dict(c) for c in g], True)]
    want = sorted((c["query_id"], c["tid"], tuple(h["at"] for h in c["hits"]), round(c["weighted"], 6), c["tie_group_id"], c["tie_count"]) for c in want)
    assert rows(5000) == rows(7) == want and any(r[4] for r in want)
    monkeypatch.setattr(C, "SLICE_BYTES", 1)
    assert rows(5000) == want


def test_calls_of_small_keys_are_dealt_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(C, "written", lambda df, name="table": (seen.append(df), written(df, name))[1])
    calls = spark.createDataFrame(random_calls(random.Random(35), 12), CALL).drop("_id")
    made = C.resolved(C.lean(calls), True)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (*seen, made) if "hits" in df.columns]
    assert made.count() and sum(plan.count("Exchange") for plan in plans) == 1
