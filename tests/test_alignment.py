"""Banded alignments, seed extensions and masked runs against plain loops."""

import random
import re

import numpy as np
import pytest

from lociweave.functions.scalars import reverse_complement
from lociweave.operators.alignment import Costs, banded_alignments
from lociweave.operators.low_complexity import masked_runs, soft_masked
from lociweave.plans.realign import extended, realigned, seed_extensions, significance_rate
from lociweave.plans.seeding import minimiser_seeds, seed_chains

LOW = -(10**9)
BACK = str.maketrans("ACGT", "TGCA")


def dna(rng, n, letters="ACGT"):
    return "".join(rng.choices(letters, k=n))


def changed(rng, text, rate):
    out = []
    for c in text:
        r = rng.random()
        if r < rate:
            out.append(rng.choice("ACGT"))
        elif r < 1.5 * rate:
            out.append(c + dna(rng, rng.randint(1, 4)))
        elif r > 1 - rate / 2:
            continue
        else:
            out.append(c)
    return "".join(out)


def plain_score(q, t, diagonal, band, costs):
    """Best local score over the cells of the band, a cell at a time."""
    h, e, f, best = {}, {}, {}, 0
    for i in range(len(q)):
        for j in range(max(0, i + diagonal - band), min(len(t), i + diagonal + band + 1)):
            e[i, j] = max(h.get((i - 1, j), LOW) - costs.gap_first, e.get((i - 1, j), LOW) - costs.gap_next)
            f[i, j] = max(h.get((i, j - 1), LOW) - costs.gap_first, f.get((i, j - 1), LOW) - costs.gap_next)
            s = costs.match if q[i] == t[j] and q[i] in "ACGT" else -costs.mismatch
            h[i, j] = max(0, h.get((i - 1, j - 1), 0) + s, e[i, j], f[i, j])
            best = max(best, h[i, j])
    return best


def checked(q, t, made, costs):
    """The score that the CIGAR says, after checking that it fits the texts."""
    score, q0, q1, t0, t1, same, other, extra, missing, cigar = made
    i, j, total = q0, t0, 0
    counts = dict.fromkeys("=XID", 0)
    for n, op in re.findall(r"(\d+)([=XID])", cigar):
        n = int(n)
        counts[op] += n
        for k in range(n if op in "=X" else 0):
            equal = q[i + k] == t[j + k] and q[i + k] in "ACGT"
            assert equal == (op == "=")
            total += costs.match if equal else -costs.mismatch
        if op in "ID":
            total -= costs.gap_first + (n - 1) * costs.gap_next
        i, j = i + n * (op in "=XI"), j + n * (op in "=XD")
    assert (i, j) == (q1, t1) and (same, other, extra, missing) == tuple(counts[o] for o in "=XID") and total == score
    return score


@pytest.mark.parametrize("costs", [Costs(), Costs(2, 4, 5, 5), Costs(1, 1, 2, 1)])
def test_scores_equal_plain_dynamic_programs(costs):
    rng = random.Random(11)
    pairs = []
    for _ in range(60):
        q = dna(rng, rng.randint(0, 60), rng.choice(["ACGT", "AC", "ACGTN"]))
        t = dna(rng, rng.randint(0, 20)) + changed(rng, q, rng.choice([0, 0.1, 0.3])) + dna(rng, rng.randint(0, 20))
        pairs.append((q, t, rng.randint(-10, 25), 8))
    pairs += [("", "", 0, 8), ("ACGT", "", 0, 8), ("", "ACGT", 3, 8), ("NNNN", "NNNN", 0, 8), ("ACGTACGT", "ACGTACGT", 1000, 8)]
    made = banded_alignments([q.encode() for q, *_ in pairs], [t.encode() for _, t, *_ in pairs], [d for *_, d, _ in pairs], 8, costs)
    for (q, t, d, band), found in zip(pairs, made, strict=True):
        assert checked(q, t, found, costs) == plain_score(q, t, d, band, costs)


def test_blocks_do_not_change_what_is_found(monkeypatch):
    from lociweave.operators import alignment

    rng = random.Random(3)
    q = [dna(rng, rng.randint(1, 50)).encode() for _ in range(30)]
    whole = banded_alignments(q, q[::-1], [0] * 30, 6)
    monkeypatch.setattr(alignment, "CELLS", 700)
    assert banded_alignments(q, q[::-1], [0] * 30, 6) == whole


def test_realigned_copies_of_both_strands(spark):
    rng = random.Random(6)
    query = dna(rng, 600)
    copies = [query[:200] + query[203:400] + "GATTACA" + query[400:], query.translate(BACK)[::-1], changed(rng, query, 0.03)]
    parts = [dna(rng, 900) for _ in range(4)]
    contig = parts[0] + copies[0] + parts[1] + copies[1] + parts[2] + copies[2] + parts[3]
    queries, targets = spark.createDataFrame([("q", query)], "q string, s string"), spark.createDataFrame([("c", contig)], "c string, s string")
    chains = seed_chains(minimiser_seeds(queries, "q", targets, "c", "s", 15, 5)[0], "q", "c", 15)
    rows = sorted(realigned(chains, queries, "q", targets, "c", "s", band=40).collect(), key=lambda r: r["target_start"])
    costs, at = Costs(), 0
    best = [max((r for r in rows if lo - 50 <= r["target_start"] <= lo + 50), key=lambda r: r["score"]) for lo in (900, 900 + len(copies[0]) + 900, 900 * 3 + len(copies[0]) + 600)]
    for row, copy, strand in zip(best, copies, "+-+", strict=True):
        own = query if strand == "+" else query.translate(BACK)[::-1]
        at = (row["query_start"], row["query_end"]) if strand == "+" else (600 - row["query_end"], 600 - row["query_start"])
        made = (row["score"], *at, row["target_start"], row["target_end"], row["matches"], row["mismatches"], row["inserted"], row["deleted"], row["cigar"])
        assert row["strand"] == strand and checked(own, contig, made, costs) == row["score"] >= len(copy) * 0.6
    assert best[0]["cigar"].count("I") == 1 and best[0]["inserted"] == 3 and best[0]["deleted"] == 7 and best[1]["cigar"] == "600="


def plain_extension(same, first, last, match, mismatch, drop):
    ends, total = [], sum(match if x else -mismatch for x in same[first:last])
    for values in (same[last:], same[:first][::-1]):
        now = best = at = 0
        for k, x in enumerate(values, 1):
            now += match if x else -mismatch
            if now > best:
                best, at = now, k
            if best - now > drop:
                break
        ends.append(at)
        total += best
    return first - ends[1], last + ends[0], total


def test_extensions_equal_plain_loops():
    rng = random.Random(12)
    for _ in range(300):
        same = [rng.random() < rng.choice([0.5, 0.8]) for _ in range(rng.randint(1, 60))]
        first = rng.randrange(len(same))
        last = rng.randint(first, len(same))
        drop = rng.choice([0, 3, 20])
        assert extended(np.array(same), first, last, 1, 2, drop) == plain_extension(same, first, last, 1, 2, drop)


def test_significance_rate_solves_its_equation():
    assert significance_rate(1, 2) == pytest.approx(1.3316, abs=2e-3) and significance_rate(1, 1) == pytest.approx(np.log(3), abs=1e-6)


def test_seed_extensions_and_their_cuts(spark):
    rng = random.Random(13)
    query = dna(rng, 300)
    near = "".join("ACGT"[("ACGT".index(c) + 1) % 4] if k % 40 == 20 else c for k, c in enumerate(query))
    contig = dna(rng, 700) + near + dna(rng, 400) + query.translate(BACK)[::-1].lower()
    queries, targets = spark.createDataFrame([("q", query)], "q string, s string"), spark.createDataFrame([("c", contig)], "c string, s string")
    seeds = minimiser_seeds(queries, "q", targets, "c", "s", 15, 5)[0]
    made = seed_extensions(seeds, queries, "q", targets, "c", "s", 15)
    best = made.where("evalue < 1e-20 AND identity > 90")
    rows = {r["strand"]: r for r in best.collect()}
    assert (rows["+"]["target_start"], rows["+"]["target_end"]) == (700, 1000) and rows["+"]["identical"] == 293 and rows["+"]["score"] == 293 - 14
    assert (rows["-"]["target_start"], rows["-"]["target_end"], rows["-"]["identity"]) == (1400, 1700, 100.0)
    assert rows["-"]["evalue"] == pytest.approx(0.621 * 300 * 1700 * np.exp(-significance_rate(1, 2) * 300))
    assert best.count() == 2 and "Filter" in best._jdf.queryExecution().optimizedPlan().toString()
    assert made.where(made["target_start"] == 700).select(reverse_complement(made["strand"])).count() == 1


def plain_runs(seq, window, threshold):
    size = min(window, len(seq))
    masked = set()
    for i in range(len(seq) - size + 1 if size >= 4 else 0):
        own = [seq[k : k + 3] for k in range(i, i + size - 2) if set(seq[k : k + 3]) <= set("ACGT")]
        if sum(own.count(v) * (own.count(v) - 1) / 2 for v in set(own)) > threshold * (size - 3):
            masked.update(range(i, i + size))
    ends = [k for k in sorted(masked) if k + 1 not in masked]
    return [(max(k for k in sorted(masked) if k <= e and k - 1 not in masked), e + 1) for e in ends]


def test_masked_runs_equal_plain_windows(spark):
    rng = random.Random(14)
    rows = [(i, "".join(dna(rng, rng.randint(1, 60)) if rng.random() < 0.6 else rng.choice(["A", "CA", "GAT", "N"]) * rng.randint(1, 30) for _ in range(6))) for i in range(12)]
    rows += [(100, ""), (101, "ACG"), (102, "AAAAA"), (103, "AAAAAAAAAAAA"), (104, None), (105, "acac" * 20), (None, "A" * 90), (106, "N" * 90)]
    frame = spark.createDataFrame(rows, "id long, s string")
    got = masked_runs(frame, "id", "s", 24, 2.0)
    want = [(i, *run) for i, s in rows if s and i is not None for run in plain_runs(s.upper(), 24, 2.0)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    for r in soft_masked(frame, "id", "s", got).where("id IS NOT NULL AND s <> ''").collect():
        own = dict(rows)[r["id"]].upper()
        inside = {k for i, a, b in want if i == r["id"] for k in range(a, b)}
        assert r["s"] == "".join(c.lower() if k in inside else c for k, c in enumerate(own))


def test_long_contigs_are_masked_over_parts(spark):
    rng = random.Random(15)
    seq = dna(rng, 16_384 - 40) + "CA" * 60 + dna(rng, 20_000)
    (run,) = [tuple(r) for r in masked_runs(spark.createDataFrame([("c", seq)], "id string, s string"), "id", "s").collect()]
    assert run[0] == "c" and 16_280 < run[1] <= 16_344 + 5 and 16_460 <= run[2] < 16_530
