"""Substring dedup against a table of all windows, over planted repeats and rows of every odd kind."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave.llm.kernels import mix
from lociweave.llm.substring_dedup import greedy_factors, leftmost_least, remove_repeats, run_hashes

WORDS = re.compile("[^\x20\x09-\x0d]+")


def plain(rows, window):
    """(doc_id, n_words, n_removed, kept text) of every row, by a dictionary of all windows."""
    cut = [(i, WORDS.findall(t or "")) for i, t in rows]
    first = {}
    for i, words in cut:
        for k in range(len(words) - window + 1) if i is not None else ():
            v = tuple(words[k : k + window])
            first[v] = min(i, first.get(v, i))
    out = []
    for i, words in cut:
        gone = set()
        for k in range(len(words) - window + 1) if i is not None else ():
            if first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=str)


def got(df, window):
    return sorted((tuple(r) for r in remove_repeats(df, window).select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=str)


def corpus(seed, vocabulary, n=60):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    shared = [[word() for _ in range(rng.randint(8, 120))] for _ in range(8)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(0, 5)):
            piece = list(rng.choice(shared)) if rng.random() < 0.6 else [word() for _ in range(rng.randint(1, 80))]
            if rng.random() < 0.5:  # only a part, or with a changed word
                a = rng.randrange(len(piece))
                piece = piece[a:] if rng.random() < 0.5 else [*piece[:a], "Changed", *piece[a + 1 :]]
            text += piece
        rows.append((rng.choice([i, i, i, i // 2, None]) if i % 7 == 0 else i, rng.choice([" ", "\n", "  \t"]).join(text)))
    return rows


ODD = [
    (None, None), (500, None), (501, ""), (502, " \n "), (503, "a " * 300), (504, "a " * 200 + "b"), (505, "é　x " * 60), (506, "é　x " * 60),
    (507, "\x0bq\x00r " * 70), (508, "tail" + " a" * 90), (None, "a " * 300), (503, "a " * 300), (509, "y " * 49), (510, "y " * 49),
]


@pytest.mark.parametrize(("seed", "vocabulary", "window"), [(1, 10_000, 20), (2, 3, 20), (3, 10_000, 50), (4, 2, 7), (5, 5, 1), (6, 50, 2)])
def test_equals_all_windows(spark, seed, vocabulary, window):
    rows = corpus(seed, vocabulary) + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    df = df.withColumns({c: F.lit(1) for c in ("own", "cuts", "at", "n", "source", "factors", "n_words", "_hot", "code", "word", "bit", "block")})
    assert got(df, window) == plain(rows, window)


def test_long_text_and_many_copies(spark):
    rng = random.Random(9)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(40_000))
    passage = " ".join(f"p{k}" for k in range(180))
    rows = [(i, f"own{i} start{i} {passage} own{i} end{i}") for i in range(400)] + [(1000, long), (1001, f"x {long} y"), (1002, long[7000:90_000])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert got(df, 50) == plain(rows, 50)


def test_factors_name_a_smaller_source(spark):
    a, b = " ".join(f"a{k}" for k in range(80)), " ".join(f"b{k}" for k in range(80))
    rows = [(1, f"{a} one"), (2, f"two {b}"), (3, f"{a} x {b}")]
    out = {r["doc_id"]: r["factors"] for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not out[1] and not out[2]
    spans = {s["source"]: (s["start"], s["stop"]) for s in out[3]}
    assert spans == {1: (0, 80), 2: (81, 161)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(df).columns == ["doc_id", "text", "n_words", "n_removed", "kept_text", "factors"] and got(df, 50) == []


def test_run_hashes_tell_orders_and_lengths_apart():
    words = mix(np.arange(1, 4, dtype=np.uint64))[np.array([0, 1, 2, 0, 1, 2, 1, 0, 2, 0, 1, 2])]
    for size in (1, 2, 3, 5):
        (made,) = run_hashes(words, [size], np.uint64(7))
        runs = [tuple(words[k : k + size].tolist()) for k in range(len(words) - size + 1)]
        assert len({*made.tolist()}) == len({*runs}) and len({*zip(runs, made.tolist(), strict=True)}) == len({*runs})


def test_leftmost_least_equals_a_scan():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 5, 200).astype(np.uint64)
    for width in (1, 2, 5, 8, 35):
        assert leftmost_least(values, width).tolist() == [k + int(np.argmin(values[k : k + width])) for k in range(200 - width + 1)]


def test_greedy_factors_break_where_the_source_changes():
    made = greedy_factors(np.array([10, 0, 5]), np.array([70, 60, 66]), np.array([2, 1, 1]))
    assert made == [(0, 66, 1), (10, 70, 2)]
