"""Vector codes against plain Lloyd rounds in Python integers, and rows of every odd kind."""

import hashlib
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lociweave.llm import vector_codes
from lociweave.llm.vector_codes import Entries, VectorCodes, encode_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, positions=8, k=16, rounds=6):
    """{(vec_id, vector): (code, error, label_error)} and the digest."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max(len(v) for _, v, _ in kept) // positions)
    cut = {}
    for i, v, _ in kept:
        whole = [math.floor(4096 * x) for x in v] + [0] * (positions * width - len(v))
        cut[i, tuple(v)] = [tuple(whole[p * width : (p + 1) * width]) for p in range(positions)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:k]
    books = [[cut[i, tuple(v)][p] for i, v, _ in first] for p in range(positions)]
    near = lambda p, x: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        held = defaultdict(list)
        for i, v, _ in kept:
            for p, x in enumerate(cut[i, tuple(v)]):
                held[p, near(p, x)[1]].append(x)
        for (p, e), xs in held.items():
            books[p][e] = tuple(sum(c) // len(xs) for c in zip(*xs, strict=True))
    out, by_label = [], defaultdict(int)
    for i, v, label in kept:
        found = [near(p, x) for p, x in enumerate(cut[i, tuple(v)])]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
        by_label[label] += out[-1][2]
    digest = hashlib.sha256(",".join(str(n) for book in books for entry in book for n in entry).encode()).hexdigest()
    return sorted(((i, code, error, by_label[label], digest) for i, code, error, label in out), key=str)


def got(df, **options):
    return sorted((tuple(r) for r in encode_vectors(df, **options).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_rounds(spark, seed, monkeypatch):
    monkeypatch.setattr(vector_codes, "CHUNK", 64)
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(12)]
    rows = []
    for i in range(500):
        v = [float(round(rng.gauss(c, 0.2), 3)) for c in rng.choice(centres)]
        rows.append((i if i % 50 else None, v, rng.choice([None, 1, 1, 1, 2])))
    rows += [(1000 + i, rows[0][1], 1) for i in range(200)] + [(2000, None, 1), (2001, [None] * 16, 2), (2002, [float("nan")] * 16, 2), (2003, [float("inf")] + [0.0] * 15, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5).withColumns({"code": F.lit(1), "error": F.lit("x"), "_n": F.lit(2)})
    assert got(df) == plain(rows)


def test_heaps_leave_most_parts_alone(spark):
    rng = random.Random(3)
    rows = [(i, [float(8 * (i % 16)) + rng.gauss(0, 0.01) for _ in range(8)], 0) for i in range(2000)]
    fitted = VectorCodes(spark.createDataFrame(rows, SCHEMA))
    assert fitted.looked[0] == 8 * 2000
    assert all(n < 0.05 * 8 * 2000 for n in fitted.looked[2:])


def test_few_short_and_far_vectors(spark):
    rows = [(3, [1.5] * 5, None), (3, [-0.25], None), (1, [], 4), (2, [1e30, -1e30], 4)]
    df = spark.createDataFrame(rows, SCHEMA)
    made = {r["vec_id"]: r for r in encode_vectors(df.where("vec_id < 3")).collect()}
    assert made[1]["error"] == 0 and made[2]["label_error"] == made[1]["label_error"]
    assert got(df.where("vec_id <> 2")) == plain([r for r in rows if r[0] != 2])


def test_no_rows_and_no_usable_rows(spark):
    df = spark.createDataFrame([(1, None, 1)], SCHEMA)
    for frame in (df, df.limit(0)):
        out = encode_vectors(frame)
        assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and out.count() == 0


def test_one_entry_never_drifts_apart():
    import numpy as np

    entries = Entries(np.zeros((1, 1, 2), np.int64))
    after = entries.moved(np.array([[[7, -7]]]), np.array([[2]]))
    assert after.books.tolist() == [[[3, -4]]] and after.drift[0, 0] > 0
