"""Minimisers, occurrence cut and chains of seeds against plain loops."""

import random
from collections import Counter

import numpy as np
import pytest

from lociweave.operators.bit_filter import code_bits, passing
from lociweave.operators.minimisers import MIXED, PRIME, TIMES, minimisers
from lociweave.operators.stretches import overlapping
from lociweave.plans.seeding import best_candidates, best_chain, minimiser_seeds, seed_chains

BACK = str.maketrans("ACGT", "TGCA")


def plain_minimisers(seq, k, w):
    """{(place, code, reverse)}"""
    found = []
    for i in range(len(seq) - k + 1):
        v = seq[i : i + k]
        r = v.translate(BACK)[::-1]
        if set(v) <= set("ACGT") and v != r:
            code = int(min(v, r).translate(str.maketrans("ACGT", "0123")), 4)
            found.append((((code ^ MIXED) % PRIME) * TIMES % PRIME, i, code, r < v))
        else:
            found.append(None)
    out = set()
    for i in range(max(1, len(found) - w + 1)):
        window = [f for f in found[i : i + w] if f]
        if window:
            out.add(min(window)[1:])
    return out


def dna(rng, n):
    return "".join(rng.choices("ACGT", k=n))


@pytest.mark.parametrize(("k", "w"), [(5, 3), (4, 1), (19, 5), (31, 10)])
def test_minimisers_equal_a_scan(spark, k, w):
    rng = random.Random(k)
    rows = [(i, dna(rng, rng.randint(0, 200))) for i in range(20)] + [(None, "ACGTN" * 20), (90, "A" * 80), (91, "acgtt" * 20), (92, None), (93, dna(rng, 40_000)), (94, "ACéGT" * 9)]
    got = minimisers(spark.createDataFrame(rows, "id long, s string"), "id", "s", k, w).collect()
    want = [(i, len(s), *m) for i, s in rows if s for m in plain_minimisers(s.upper(), k, w)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_lower_case_can_be_masked(spark):
    rows = spark.createDataFrame([(1, "acgtacca" * 5)], "id long, s string")
    assert minimisers(rows, "id", "s", 5, 2, masked=True).count() == 0 < minimisers(rows, "id", "s", 5, 2).count()


def test_overlapping_parts_hold_their_surroundings(spark):
    seq = dna(random.Random(4), 1000)
    made = overlapping(spark.createDataFrame([("a", seq), ("b", ""), ("c", "ACG")], "name string, seq string"), 7, 11, size=64).collect()
    assert sorted((r["own"], r["until"]) for r in made if r["contig"] == "a") == [(i, min(1000, i + 64)) for i in range(0, 1000, 64)]
    for r in made:
        whole = seq if r["contig"] == "a" else "ACG"
        assert r["piece"] == whole[max(0, r["own"] - 7) : r["until"] + 11] and r["start"] == max(0, r["own"] - 7)


def test_seeds_of_both_strands_and_the_cut(spark):
    rng = random.Random(2)
    genome = [dna(rng, 3000) for _ in range(3)]
    often = dna(rng, 40)
    genome = [g + often * 6 for g in genome]
    queries = [(0, genome[0][500:900]), (1, genome[1][100:400].translate(BACK)[::-1]), (2, often), (3, dna(rng, 100)), (4, "ACG")]
    seeds, repeats = minimiser_seeds(spark.createDataFrame(queries, "q long, s string"), "q", spark.createDataFrame(list(enumerate(genome)), "t long, s string"), "t", "s", 15, 5, most=9)
    found = {i: plain_minimisers(s, 15, 5) for i, s in queries}
    held = {i: plain_minimisers(s, 15, 5) for i, s in enumerate(genome)}
    n = Counter(code for own in held.values() for _, code, _ in own)
    want = sorted((q, a, t, b, x != y) for q, own in found.items() for a, c, x in own for t, other in held.items() for b, d, y in other if c == d and n[c] <= 9)
    assert sorted((r["q"], r["query_at"], r["t"], r["target_at"], r["reverse"]) for r in seeds.collect()) == want and any(r[4] for r in want)
    codes = {c for own in found.values() for _, c, _ in own}
    assert {(r["code"], r["n"]) for r in repeats.collect()} == {(c, m) for c, m in n.items() if m > 9 and c in codes} != set()


def plain_chains(anchors, k, max_gap, band, least, score):
    """Chains of sorted (t, q) anchors, the best first, each taking its own."""
    out, left = [], sorted(set(anchors))
    while left:
        best = []
        for i, (t, q) in enumerate(left):
            top = (k, -1)
            for j in range(i):
                dq, dt = q - left[j][1], t - left[j][0]
                if 0 < dq <= max_gap and 0 < dt <= max_gap and abs(dt - dq) <= band and best[j][0] + min(k, dq, dt) > top[0]:
                    top = (best[j][0] + min(k, dq, dt), j)
            best.append(top)
        end = max(range(len(left)), key=lambda i: (best[i][0], -i))
        if best[end][0] < score:
            return out
        chain, at = [], end
        while at >= 0:
            chain.append(at)
            at = best[at][1]
        own = [left[i] for i in chain[::-1]]
        if len(own) >= least:
            out.append((own[0][1], own[-1][1] + k, own[0][0], own[-1][0] + k, best[end][0], len(own)))
        left = [a for i, a in enumerate(left) if i not in set(chain)]
    return out


def test_chains_equal_plain_loops_without_islands(spark):
    rng = random.Random(8)
    rows, want = [], []
    for group in range(12):
        reverse, anchors = group % 2 == 1, set()
        for _ in range(rng.randint(1, 5)):
            t, q = rng.randrange(4000), rng.randrange(500)
            for _ in range(rng.randint(1, 12)):
                anchors.add((t, q))
                t, q = t + rng.randint(1, 60), q + rng.randint(1, 60)
        rows += [(group, 1500, 1500 - 10 - q if reverse else q, 7, 9000, t, reverse) for t, q in anchors for _ in range(rng.randint(1, 2))]
        # groups by islands must not change what is found, though chains of apart islands may come in another order
        for q0, q1, t0, t1, bases, n in plain_chains(anchors, 10, 100, 30, 3, 20):
            want.append((group, *((1500 - q1, 1500 - q0) if reverse else (q0, q1)), "-" if reverse else "+", 7, t0, t1, bases, n))
    seeds = spark.createDataFrame(rows, "q long, query_length long, query_at long, t long, target_length long, target_at long, reverse boolean")
    got = seed_chains(seeds, "q", "t", 10, max_gap=100, band=30, least_anchors=3, least_score=20)
    columns = ["q", "query_start", "query_end", "strand", "t", "target_start", "target_end", "bases", "anchors"]
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(want) and len(want) > 12


def test_a_mutated_copy_is_one_chain_at_its_place(spark):
    rng = random.Random(5)
    query = dna(rng, 800)
    copy = "".join(rng.choice("ACGT") if rng.random() < 0.02 else c for c in query)
    copy = copy[:300] + dna(rng, 25) + copy[300:]
    contig = dna(rng, 5000) + copy.translate(BACK)[::-1] + dna(rng, 3000)
    seeds, _ = minimiser_seeds(spark.createDataFrame([("q", query)], "q string, s string"), "q", spark.createDataFrame([("c", contig)], "c string, s string"), "c", "s", 15, 5)
    chain = best_candidates(seed_chains(seeds, "q", "c", 15), "q", 1).first()
    assert chain["strand"] == "-" and abs(chain["target_start"] - 5000) < 60 and abs(chain["target_end"] - 5825) < 60 and chain["query_end"] - chain["query_start"] > 700


def test_best_chain_of_lone_and_equal_anchors():
    places, score = best_chain(np.array([5]), np.array([9]), 4, 10, 3)
    assert places.tolist() == [0] and score == 4
    places, score = best_chain(np.array([5, 5, 8]), np.array([9, 10, 12]), 4, 10, 3)
    assert places.tolist() == [0, 2] and score == 7


def test_bit_filter_holds_all_its_codes(spark):
    codes = [0, -1, 5, 1 << 40, -(1 << 62)]
    bits = code_bits(spark.createDataFrame([(c,) for c in codes], "code long"))
    assert passing(bits, np.array(codes, np.int64).view(np.uint64)).tolist() == [0, 1, 2, 3, 4]
    assert not code_bits(spark.createDataFrame([], "code long")).any()
