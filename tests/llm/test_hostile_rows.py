"""Inputs made to break hashes and row keys."""

import random
from collections import Counter

from pyspark.sql import functions as F

from lociweave.llm import exact_dedup, jaccard_join, line_dedup

PARITY = "".join("ab"[i.bit_count() % 2] for i in range(1024))
OTHER = PARITY.translate(str.maketrans("ab", "ba"))
BASE = " ".join(f"v{random.Random(3).randint(0, 10**9) + k}" for k in range(60))
OWN = " ".join(f"u{k * 7919}" for k in range(60))


def test_lines_whose_power_sums_agree_are_two_lines(spark):
    docs = spark.createDataFrame([(1, PARITY), (2, PARITY), (3, OTHER)], "doc_id long, text string")
    assert all(r.n_dropped == 0 for r in line_dedup.dedup_lines(docs).collect())


def test_words_and_orders_whose_sums_agree_are_two_sets(spark):
    rows = [(1, PARITY), (2, OTHER), (3, "a b b a"), (4, "b a a b"), (5, PARITY[:16]), (6, OTHER[:16]), (7, "a b b a b a a b"), (8, "b a a b a b b a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicate_components(docs, words=4, percent=85).collect()}
    assert got == {i: i for i, _ in rows}


def kept(frame):
    return Counter((r.doc_id, r.text, r.mark) for r in frame.select("doc_id", "text", "mark").collect())


def test_one_of_each_judges_rows_and_not_ids(spark):
    rows = [(1, BASE, 0), (3, OWN, 1), (3, BASE, 2), (None, BASE + " tail", 3), (None, None, 4), (None, None, 4), (9, "", 5), (7, OWN, 6), (3, OWN, 1), (None, "nobody's own words of some length here", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark int").withColumns({c: F.lit(1) for c in ("_id", "_key", "group", "set_id", "key")})
    out = jaccard_join.one_of_each(docs)
    assert out.columns == docs.columns
    assert kept(out) == Counter([(1, BASE, 0), (3, OWN, 1), (None, None, 4), (None, None, 4), (9, "", 5), (None, "nobody's own words of some length here", 7)])
    assert jaccard_join.one_of_each(docs.limit(0)).count() == 0


def test_without_copies_judges_rows_and_not_ids(spark):
    rows = [(1, "a b", 0), (2, "a  b", 1), (2, "own", 2), (None, "own", 3), (2, "another", 4), (1, "another", 5), (None, "q", 6), (5, "r s", 7), (5, "rs", 8), (5, "r\ts", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark int").withColumns({c: F.lit(1) for c in ("_id", "_key", "kept", "points", "word")})
    out = exact_dedup.without_copies(docs)
    assert out.columns == docs.columns
    got = kept(out)
    assert sum(got.values()) == 5 and {m for _, _, m in got} - {7, 9} == {1, 2, 5, 6}
    assert exact_dedup.without_copies(docs.limit(0)).count() == 0


def test_filter_rounds_give_the_same_rows(spark):
    docs = spark.createDataFrame([(i, f"text {i % 700}") for i in range(1000)], "doc_id long, text string")
    want = sorted(map(tuple, exact_dedup.exact_dedup(docs).collect()))
    assert want == sorted(map(tuple, exact_dedup.exact_dedup(docs, filter_words=64).collect()))
    assert sum(not r[3] for r in want) == 300
