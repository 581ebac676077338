"""Edge cases of every operator, and brute-force versions of those that SQL cannot express."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF, rows_of
from pyspark.sql import functions as F

from lociweave import storage
from lociweave.llm import decontamination, exact_dedup, jaccard_join, licences, line_dedup, mixing, quality, queries, sharding, token_shards, warc

WORDS = re.compile("[^\x20\x09-\x0d]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = ("key", "h", "n", "token", "set_id", "block", "slot", "size", "shard", "word", "bits", "text_sha256", "score", "row", "_found", "_rank", "item_ids", "component")


def clashing(df, *but):
    return df.withColumns({c: F.lit(1) for c in CLASHING if c not in but})


rng = random.Random(7)
LONG = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(30_000))
BASE = " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(120))
ODD = [
    (0, None), (1, ""), (2, " \t\n "), (3, "One short line"), (4, LONG), (5, BASE), (6, BASE.upper()), (7, BASE + " tail"), (7, BASE + " tail"), (None, BASE),
    (None, "nobody's own text, long enough to be a line key"), (8, "é" * 25 + "\n\n" + "é" * 25), (9, "\x00 odd   white space \U0001f600"), (10, LONG + " more"), (3, "One short line"),
]


@pytest.fixture(scope="module")
def odd(spark):
    frame = spark.createDataFrame([(i, t, "en", None if i == 2 else "s", len(t or "")) for i, t in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    return clashing(frame.repartition(3))


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


ORACLE = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, oracle, name):
    assert rows_of(queries.queries()[name](spark, SF).toPandas()) == oracle(ORACLE[name])


# ---------------------------------------------------------------- 1 line dedup


def brute_lines(rows, min_docs=3):
    key = lambda line: line.strip(" \t\n\v\f\r").translate(ASCII_LOWER)
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(i)
    last = {k: max((i for i in own if i is not None), default=None) for k, own in held.items() if len(own) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == i]
        out.append((str(i), "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


LINES = [(i, "\n".join(rng.choice([f"  Shared line number {k} of the corpus\t" for k in range(6)] + ["short", "", f"own line of document {i} {j} here"]) for j in range(rng.randint(1, 9)))) for i in [*range(40), None]]


def found_lines(frame):
    return sorted((str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in frame.collect())


def test_line_dedup_equals_brute_force(spark, odd, empty):
    assert found_lines(line_dedup.dedup_lines(odd)) == brute_lines(ODD)
    assert found_lines(line_dedup.dedup_lines(spark.createDataFrame(LINES, "doc_id long, text string"))) == brute_lines(LINES)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_is_reversible(spark):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    state = line_dedup.LineDedup(spark, shards=2).add(frame(LINES[:25])).add(frame(LINES[25:])).delete(frame(LINES[5:30]))
    rest = LINES[:5] + LINES[30:]
    lines = line_dedup.line_keys(frame(rest), "doc_id", "text", 20)
    got = Counter(r.doc_id for r in state.dropped(lines).collect())
    assert {str(i): n for i, n in got.items()} == {i: d for i, _, _, d in brute_lines(rest) if d}


def test_cuckoo_filter_holds_and_forgets():
    keys = np.random.default_rng(1).integers(0, 2**63, 3000).astype(np.uint64)
    held = line_dedup.CuckooFilter.of(keys)
    assert held.test(keys).all() and held.test(keys + np.uint64(1)).mean() < 0.01
    for f, a, b in zip(*held.places(keys[:1500]), strict=True):
        held.remove(int(f), int(a), int(b))
    assert held.test(keys[1500:]).all() and held.test(keys[:1500]).mean() < 0.01


def test_a_line_of_a_third_of_all_rows_is_dealt_over_groups(spark):
    docs = spark.createDataFrame([(i, "the same line in very many documents\n" + f"a line of its own, number {i}") for i in range(6000)], "doc_id long, text string")
    lines = storage.written(line_dedup.line_keys(docs, "doc_id", "text", 20))
    state = line_dedup.LineDedup(spark, shards=4).changed(lines, 1)
    gone = state.dropped(lines)
    assert gone.count() == 5999 and gone.agg(F.max("doc_id")).first()[0] == 5998
    assert line_dedup.dedup_lines(docs).agg(F.sum("n_dropped")).first()[0] == 5999


# ---------------------------------------------------------------- 2 quality


def test_quality_learns_on_one_fold_and_holds_on_the_other(spark):
    docs, labels = (spark.read.parquet(f"{SF[:-5]}0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.score_documents(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert ((got.score >= 0.7) == (got.predicted == 1)).all()
    met = got.merge(labels.toPandas(), on="doc_id")
    held = met[met.held_out]
    good, bad = held.score[held.quality == 1].to_numpy(), held.score[held.quality == 0].to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.97
    # held-out labels change nothing
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.score_documents(docs, turned).toPandas()
    assert np.allclose(got.sort_values("doc_id").score, again.sort_values("doc_id").score)


def test_features_do_not_depend_on_neighbours():
    texts = ["one small text", "", "Another one, with 3 marks!", "w " * 100]
    alone = np.concatenate([x for t in texts for _, x in quality.passage_features(pa.array([t]))])
    assert (alone == np.concatenate([x for _, x in quality.passage_features(pa.array(texts))])).all()


def test_quality_of_odd_tables(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1), (5, None), (None, 0)], "doc_id long, quality int")
    got = quality.score_documents(odd, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert quality.score_documents(empty, labels).count() == 0
    one = spark.createDataFrame([(i, i % 2) for i in (0, 3, 4, 5, 6, 8)], "doc_id long, quality int")
    assert quality.score_documents(odd, one).where("score IS NULL").count() == 0
    assert set(quality.keep_good(odd, labels).columns) == set(odd.columns)


def test_gradient_is_the_slope():
    r = np.random.default_rng(0)
    x, counts, y = r.standard_normal((9, quality.FEATURES)).astype(np.float64), np.array([2, 4, 3]), np.array([1.0, 0.0, 1.0])
    model = quality.fit(x.astype(np.float32), counts, y.astype(np.float32), 0.5, epochs=1)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}

    def loss():
        z = model.forward(x, counts)["logit"]
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    for name, g in model.gradient(x, counts, y).items():
        w = model.weights[name]
        at = tuple(int(v) for v in np.unravel_index(np.argmax(np.abs(g)), g.shape))
        w[at] += 1e-5
        up = loss()
        w[at] -= 2e-5
        assert abs((up - loss()) / 2e-5 - g[at]) < 1e-4, name
        w[at] += 1e-5


# ---------------------------------------------------------------- 3 licences


def test_licences_are_found_and_inherited(spark):
    rows = [
        ("a/LICENSE", "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files"),
        ("a/b/c/x.py", "print(1)"), ("a/b/y.py", "# Licensed under the Apache License, Version 2.0."), ("a/b/c/d/z.py", None), ("e/f.py", ""), ("g.py", "the licence of the street"), (None, "x"),
        ("c/one.py", "Released under the MIT License."), ("c/sub/two.py", "x = 2"), ("a/b/COPYING", "Licensed under CC BY 4.0."), ("a/b/c/d/LICENSE.md", "all ours"),
    ]
    files = clashing(spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string"))
    got = {r.key: (r.licence, r.basis, r.from_path) for r in licences.scan_licences(files, "doc_id", "path", "text").collect()}
    assert got == {
        0: ("MIT", "own", "a/LICENSE"), 1: ("CC-BY-4.0", "inherited", "a/b/COPYING"), 2: ("Apache-2.0", "own", "a/b/y.py"),
        3: ("CC-BY-4.0", "inherited", "a/b/COPYING"), 4: (None, "none", None), 5: (None, "none", None), 6: (None, "none", None), 7: ("MIT", "own", "c/one.py"),
        8: (None, "none", None), 9: ("CC-BY-4.0", "own", "a/b/COPYING"), 10: ("CC-BY-4.0", "inherited", "a/b/COPYING"),
    }


def test_licences_that_most_texts_state_are_found(spark):
    notice = "Licensed under CC BY 4.0."
    rows = [(i, f"p{i}/f.txt", f"text {i}\n{notice}" if i % 4 else f"text {i} by the sea, under 4 trees") for i in range(200)]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.key: (r.licence, r.basis) for r in licences.scan_licences(files, "doc_id", "path", "text").collect()}
    assert got == {i: ("CC-BY-4.0", "own") if i % 4 else (None, "none") for i in range(200)}


def test_common_words_beside_a_notice_have_their_own_frequency(spark):
    texts = ["this and that for the use in her is it are of a work"] * 3000 + ["Licensed for under that CC and BY the 4.0 her.", "This licensed and under that CC in BY the 4.0 are."]
    files = spark.createDataFrame([(i, "f.txt", t) for i, t in enumerate(texts)], "key long, name string, text string")
    got = {r.key: (r.licence, r.score) for r in licences.own_licences(files).collect()}
    df = Counter(w for t in texts for w in set(re.findall("[a-z0-9]+", t.lower())))
    weight = lambda text: {w: n * (1 + np.log((1 + len(texts)) / (1 + df[w]))) for w, n in Counter(re.findall("[a-z0-9]+", text.lower())).items()}
    template = weight("Licensed under CC BY 4.0.")
    assert set(got) == {3000, 3001}
    for i in got:
        piece = weight(texts[i])
        cosine = sum(x * template.get(w, 0) for w, x in piece.items()) / np.sqrt(sum(x * x for x in piece.values()) * sum(y * y for y in template.values()))
        assert got[i][0] == "CC-BY-4.0" and abs(got[i][1] - cosine) < 1e-5


def test_notices_inside_lines_and_over_lines_are_found(spark):
    def wrapped(text):
        return re.sub(r"(.{1,38})(?: |$)", r"# \1\n", text)

    long = "This work is licensed under the GNU General Public License, version 3."
    prose = "Here we say at some length what the program does, whom it serves and why it was written by the two of us."
    rows = [
        ("# Copyright 2024 Jane Smith. Released under the MIT License.", "MIT"),
        ("Copyright 2021 Acme Inc. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        (f"{prose} Released under the MIT License. {prose}", "MIT"),
        (wrapped(f"{prose} {long} {prose}"), "GPL-3.0"),
        (wrapped("Copyright 2020 Some Holder. " + licences.TEMPLATES[3][1]), "Apache-2.0"),
        (f"{prose} Licensed under\nCC BY-NC\n4.0. {prose}", "CC-BY-NC-4.0"),
        ("// SPDX-License-Identifier: MIT", "MIT"), ("/* SPDX-License-Identifier: GPL-3.0-or-later */ x = 1", "GPL-3.0"),
        ("// SPDX-License-Identifier: Unheard-Of-1.0", None), (prose, None), (f"{prose} the licence of the street and the work of the author", None),
    ]
    rows += [(f"{prose} page {i}", None) for i in range(100)]
    files = spark.createDataFrame([(i, f"d{i}/x.txt", t) for i, (t, _) in enumerate(rows)], "doc_id long, path string, text string")
    got = {r.key: r.licence for r in licences.scan_licences(files, "doc_id", "path", "text").collect()}
    assert got == {i: want for i, (_, want) in enumerate(rows)}


def test_licences_of_odd_tables(odd, empty):
    assert licences.scan_documents(odd).count() >= len({i for i, _ in ODD})
    assert licences.scan_documents(empty).count() == 0


def test_licence_statements_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF[:-5]}0.01/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in licences.scan_documents(docs).collect()}
    stated = {i for i, t in text.items() if re.search("licensed under|released under", t, re.I)}
    assert len(got) == len(text) and {i for i, r in got.items() if r.basis == "own"} == stated
    for r in got.values():
        if r.basis == "inherited":
            above = r.from_path.rpartition("/")[0]
            assert r.path.startswith(above + "/") and r.from_path.endswith("/LICENSE") and r.licence


def test_scan_equals_plain_tf_idf(spark):
    """Every line, header block, licence file and every window at an anchor, by plain dictionaries."""
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    docs = [(i, f"d/{'LICENSE' if i % 9 == 0 else i}", t) for i, t in enumerate(mixed_notices())]
    files = spark.createDataFrame(docs, "key long, path string, text string").withColumn("name", F.regexp_extract("path", "([^/]*)$", 1))
    n, df = len(docs), Counter(w for *_, t in docs for w in set(words(t)))
    idf = lambda w: 1 + np.log((1 + n) / (1 + df[w]))
    vector = lambda ws: {w: c * idf(w) for w, c in Counter(ws).items()}
    length = lambda v: np.sqrt(sum(x * x for x in v.values()))
    want = {}
    for key, path, text in docs:
        lines = text.split("\n")
        header = next((k for k, x in enumerate(lines) if not re.match(licences.COMMENT, x)), len(lines))
        whole = [words(x) for x in lines] + [words("\n".join(lines[:header]))] * (header > 1) + [words(text)] * path.endswith("LICENSE")
        for number, (name, body) in enumerate(licences.TEMPLATES):
            template, own = vector(words(body)), words(body)
            squares = {w: x * x for w, x in template.items()}
            anchors, all_ = licences.anchors_of(squares, df, licences.THRESHOLD), words(text)
            cut = [all_[max(0, at - place) :][: len(own)] for at, w in enumerate(all_) for place, v in enumerate(own) if v == w and w in anchors]
            for piece in whole + cut:
                v = vector(piece)
                score = sum(x * template.get(w, 0) for w, x in v.items()) / (length(v) * length(template)) if v else 0
                if round(score, 6) >= licences.THRESHOLD:
                    want[key] = max(want.get(key, (0, "")), (round(score, 6), name))
    got = {r.key: (r.score, r.licence) for r in licences.own_licences(files.select("key", "name", "text")).collect()}
    assert set(got) == set(want) and len(want) > 20
    assert all(got[k][1] == want[k][1] and abs(got[k][0] - want[k][0]) < 2e-6 for k in want)


def mixed_notices():
    r = random.Random(5)
    prose = lambda k: " ".join(r.choice("the of and a work code is in by to for river stone under law terms version use free license".split()) for _ in range(k))
    for _ in range(120):
        own = words = r.choice(licences.TEMPLATES)[1].split()
        if r.random() < 0.5:
            own = [w if r.random() < 0.8 else prose(1) for w in words]
        text = " ".join([prose(r.randint(0, 30)), *(own if r.random() < 0.6 else []), prose(r.randint(0, 30))]).split()
        lines = [" ".join(text[k : k + 9]) for k in range(0, len(text), 9)]
        yield "\n".join(("# " if r.random() < 0.5 else "") + x for x in lines)


# ---------------------------------------------------------------- 4 exact dedup


def test_exact_dedup_equals_brute_force(odd, empty):
    groups = defaultdict(list)
    bare = lambda t: re.sub("[\x20\x09-\x0d]", "", t or "")
    for i, t in ODD:
        groups[bare(t)].append((-len(t or ""), i is None, i or 0, i))
    want = []
    for i, t in ODD:
        best = min(groups[bare(t)])
        want.append((str(i), str(best[3]), len(groups[bare(t)]), i == best[3] and len(t or "") == -best[0], hashlib.sha256(bare(t).encode()).hexdigest()))
    for words in (1, 1 << 20):
        got = [(str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_dedup(odd, filter_words=words).collect()]
        assert sorted(got) == sorted(want)
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert exact_dedup.without_copies(odd).columns == odd.columns


# ---------------------------------------------------------------- 5 token shards


def test_feistel_is_a_bijection_of_any_range():
    for n in (1, 2, 3, 17, 1000, 4097):
        f = token_shards.Feistel(n, 5)
        x = np.arange(n)
        assert sorted(f.forward(x)) == list(x) and (f.back(f.forward(x)) == x).all()
    assert (token_shards.Feistel(1000, 1).forward(np.arange(1000)) != token_shards.Feistel(1000, 2).forward(np.arange(1000))).any()


def test_token_shards_round_trip(spark, odd, empty, tmp_path):
    out = (tmp_path / "tokens").as_uri()
    rows = token_shards.write_shards(odd, out, seq_len=64, per_shard=100).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    read = list(token_shards.read_slots(out))
    by_slot = {r.slot: r for r in rows}
    assert all(hashlib.sha256(x.tobytes()).hexdigest() == by_slot[k].ids_sha256 for k, x in enumerate(read))
    assert [x.tolist() for x in token_shards.read_slots(out, 150, 20)] == [x.tolist() for x in read[150:170]]
    order = token_shards.Feistel(len(rows), 20240229).forward(np.arange(len(rows)))
    flat = np.concatenate([read[k][: by_slot[k].n_tokens] for k in order])
    encoding = token_shards._encoding(open(token_shards.VOCABULARY, "rb").read())
    texts = [encoding.decode(x[:-1].tolist()) for x in np.split(flat, np.flatnonzero(flat == token_shards.END_OF_TEXT) + 1) if len(x) > 1]
    assert sorted(texts) == sorted(t for _, t in ODD if t)
    assert {i for r in rows for i in r.doc_ids} == {i for i, t in ODD if t}
    assert token_shards.write_shards(empty, (tmp_path / "none").as_uri()).count() == 0


# ---------------------------------------------------------------- 6 WARC


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "x" * 1500 + "é</p>"
    rows = [(1, "http://a/ b\r\n", big), (2, None, big), (3, "u", None), (4, "u", ""), (5, "u", "small"), (6, "u", "small"), (None, "u", big), (7, "u", "a\r\n\r\nWARC/1.1\r\n" * 90), (2, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2).withColumns({"file": F.lit("f"), "ordinal": F.lit(1), "offset": F.lit(2)})
    out = (tmp_path / "warc").as_uri()
    got = warc.archive_pages(pages, out).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in got) == Counter(
        [(1, "revisit", 2), (2, "response", None), (2, "revisit", 2), (None, "revisit", 2), (3, "response", None), (4, "response", None), (5, "response", None), (6, "response", None), (7, "response", None)]
    )
    want = Counter((i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h in rows)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == want
    index = spark.read.parquet(f"{out}/warc/*.index.parquet")
    full = {r.page_id: bytes(r.payload).decode() for r in warc.read_records(index, payloads=True).where("record_type = 'response'").collect()}
    assert full[2] == big and full[3] == "" and full[7] == rows[7][2]
    again = warc.normalise(index.select("file").distinct(), f"{out}/again")
    assert again.count() == len(rows)
    assert warc.archive_pages(pages.limit(0)).count() == 0


# ---------------------------------------------------------------- 7 n-gram Jaccard join


def brute_components(rows, size, percent):
    sets = []
    for _, t in rows:
        w = WORDS.findall((t or "").translate(ASCII_LOWER))
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]) and group[a] != group[b]:
                group = [group[a] if g == group[b] else g for g in group]
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in set(group)}
    return Counter((str(rows[i][0]), len(sets[i]), str(least[group[i]])) for i in range(len(rows)))


def near_copies(n):
    r, out = random.Random(n), []
    bases = [[f"b{r.randint(0, 10**6)}" for _ in range(r.randint(30, 90))] for _ in range(6)]
    for i in range(n):
        words = list(r.choice(bases))
        for _ in range(r.randint(0, 4)):
            words[r.randrange(len(words))] = f"e{r.randint(0, 10**6)}"
        out.append((i, " ".join(words[: r.randint(len(words) - 8, len(words))])))
    return out


@pytest.mark.parametrize(("size", "percent", "cell"), [(4, 85, 2048), (5, 80, 5)])
def test_jaccard_components_equal_brute_force(spark, odd, empty, size, percent, cell):
    for rows, frame in ((ODD, odd), (near_copies(220), None)):
        frame = frame if frame is not None else spark.createDataFrame(rows, "doc_id long, text string")
        got = jaccard_join.near_duplicate_components(frame, words=size, percent=percent, cell=cell).collect()
        assert Counter((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_components(rows, size, percent)
    assert jaccard_join.near_duplicate_components(empty).count() == 0
    assert jaccard_join.one_of_each(odd).columns == odd.columns


def test_spanning_links_join_what_pairs_join():
    r = np.random.default_rng(3)
    base = r.integers(0, 2**63, 60).astype(np.uint64)
    sets = [np.unique(np.r_[base[r.random(60) < 0.93], r.integers(0, 2**63, 3).astype(np.uint64)]) for _ in range(60)]
    classes = np.zeros(1 << 10, np.uint8)

    def joined(pairs):
        group = list(range(len(sets)))
        for a, b in pairs:
            group = [group[a] if g == group[b] else g for g in group]
        return Counter(frozenset(i for i in range(len(sets)) if group[i] == g) for g in set(group))

    pairs = [(a, b) for a in range(60) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))]
    assert joined(jaccard_join.spanning_links(sets, classes, 85)) == joined(pairs)
    probes = np.arange(60) % 7 == 0
    assert joined(jaccard_join.spanning_links(sets, classes, 85, probes)) == joined([p for p in pairs if probes[p[0]] or probes[p[1]]])


# ---------------------------------------------------------------- 8 mixing


def test_mixing_deviates_by_less_than_a_block(spark, odd, empty):
    rows = [(i, s) for s, n in (("a", 700), ("b", 90), (None, 33)) for i in range(n)]
    docs = spark.createDataFrame([(k, s) for k, (_, s) in enumerate(rows)], "doc_id long, source string")
    weights = {"a": 0.5, "b": 0.3, None: 0.2}
    got = mixing.mix_sources(docs, weights, block_rows=8).toPandas()
    assert got.position.is_unique and set(got.doc_id) == set(range(len(rows)))
    assert (got[got.epoch == 0].groupby("doc_id").size() == 1).all() and got.epoch.max() > 0
    slots = got.drop_duplicates("slot").sort_values("slot")
    assert list(slots.slot) == list(range(len(slots)))
    for s, w in weights.items():
        own = (slots.source.isna() if s is None else slots.source == s).to_numpy().cumsum()
        assert np.abs(own - w * np.arange(1, len(own) + 1)).max() < 1
    assert mixing.mix_sources(odd).select("doc_id").distinct().count() == len({i for i, _ in ODD})
    assert mixing.mix_sources(empty).count() == 0
    assert mixing.mixed(odd).columns == odd.columns


def shares(got, weights):
    """Largest deviation, in blocks, of each source after any number of slots."""
    slots = got.drop_duplicates("slot").sort_values("slot")
    n = np.arange(1, len(slots) + 1)
    return max(np.abs((slots.source == s).to_numpy().cumsum() - w * n).max() for s, w in weights.items())


def test_mixing_keeps_the_weights_of_many_small_sources(spark):
    small = [f"s{k}" for k in range(1000)]
    names = ["hot"] * 5000 + small * 10
    docs = spark.createDataFrame(list(enumerate(names)), "doc_id long, source string")
    weights = {"hot": 5000 / 15000} | {s: 10 / 15000 for s in small}
    got = mixing.mix_sources(docs, {"hot": 5000} | {s: 10 for s in small}, block_rows=4).toPandas()
    assert set(got.doc_id) == set(range(len(names))) and sorted(got.position) == list(range(len(got)))
    assert shares(got, {s: weights[s] for s in ["hot", *small[:20]]}) < 1
    assert abs((got.source == "hot").mean() - 1 / 3) < 0.001 and len(got) < 1.3 * len(names)


def test_mixing_keeps_weights_that_are_no_thousandths(spark):
    docs = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(9000)], "doc_id long, source string")
    for weights in ({"a": 2 / 3, "b": 1 / 3}, {"a": 0.99951, "b": 0.00049}):
        docs_of = docs if weights["b"] > 0.1 else docs.where("source = 'a' OR doc_id < 15")
        got = mixing.mix_sources(docs_of, weights, block_rows=1).toPandas()
        assert shares(got, weights) < 1 and sorted(got.position) == list(range(len(got)))


def test_mixing_goes_on_with_the_next_epoch_inside_a_block(spark):
    docs = spark.createDataFrame([(i, "a" if i < 100 else "b") for i in range(105)], "doc_id long, source string")
    got = mixing.mix_sources(docs, {"a": 0.5, "b": 0.5}, block_rows=8).toPandas()
    assert sorted(got.position) == list(range(len(got))) and set(got.doc_id) == set(range(105))
    assert abs((got.source == "a").sum() - (got.source == "b").sum()) <= 8
    assert set(got[got.source == "b"].groupby("doc_id").size()) <= {len(got[got.source == "b"]) // 5, len(got[got.source == "b"]) // 5 + 1}
    alone = mixing.mix_sources(docs.where("source = 'a'"), block_rows=64).toPandas()
    assert sorted(alone.doc_id) == list(range(100)) and (alone.epoch == 0).all()


def test_hyperperiod_meets_every_window():
    for parts in ({"a": 1}, {"a": 3, "b": 3, "c": 1}, {"a": 500, "b": 499, "c": 1}, {k: p for k, p in zip("abcdefg", (7, 1, 13, 2, 2, 40, 35), strict=True)}):
        period = sum(parts.values())
        plan = mixing.hyperperiod(parts)
        assert sorted(t for *_, t in plan) == list(range(period))
        for s, j, t in plan:
            assert j * period // parts[s] <= t < -(-(j + 1) * period // parts[s])


# ---------------------------------------------------------------- 9 decontamination


@pytest.mark.parametrize("bits", [1 << 29, 64])
def test_decontamination_equals_brute_force(spark, odd, empty, bits, monkeypatch):
    monkeypatch.setattr(decontamination, "MOST_BITS", bits)  # the filter of 64 bits lets all through
    passage = " ".join(LONG.split(" ")[500:530])
    items = [(1, passage.upper().replace(" ", " - ")), (2, "one SHORT line"), (3, None), (4, "..."), (None, BASE), (5, "never anywhere at all"), (6, BASE[:200]), (1, "white")]
    rule = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    cut = lambda t: rule.findall((t or "").translate(ASCII_LOWER))
    want = Counter()
    for i, t in ODD:
        words, hit, found = cut(t), set(), set()
        for item, text in items:
            own = cut(text)
            if item is None or not own:
                continue
            n = min(10, len(own))
            windows = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)}
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found.add(str(item))
        want[(str(i), len(words), len(hit), ",".join(sorted(found)))] += 1
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.find_benchmark(odd, bench)
    assert Counter((str(r.doc_id), r.n_words, r.n_hit, ",".join(r.item_ids)) for r in got.collect()) == want
    clean = decontamination.decontaminate(odd, bench)
    assert clean.columns == odd.columns and clean.count() == sum(n for (_, _, hit, _), n in want.items() if not hit)
    assert decontamination.find_benchmark(empty, bench).count() == 0
    assert decontamination.find_benchmark(odd, bench.limit(0)).where("n_hit > 0").count() == 0


# ---------------------------------------------------------------- 10 sharding


def test_sharding_is_minimax_over_whole_groups(spark, odd, empty):
    r = random.Random(4)
    docs = spark.createDataFrame([(i, f"text {r.randint(0, 300)} " * r.randint(1, 3) * (400 if i == 5 else 1)) for i in range(900)], "doc_id long, text string")
    got = sharding.shard_documents(docs, 7).toPandas()
    keys = docs.select("doc_id", F.xxhash64("text").alias("k"), (F.octet_length("text") + 8).alias("s")).toPandas()
    sizes = keys.groupby("k").s.sum().sort_index().tolist()

    def shards_for(capacity):
        n, held = 1, 0
        for s in sizes:
            n, held = (n, held + s) if held + s <= capacity else (n + 1, s)
        return n

    best = next(c for c in range(max(max(sizes), -(-sum(sizes) // 7)), sum(sizes) + 1) if shards_for(c) <= 7)
    assert got.groupby("shard")["size"].sum().max() == best
    assert got.merge(keys, on="doc_id").groupby("k").shard.nunique().max() == 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    odd_rows = sharding.shard_documents(odd).collect()
    assert Counter((r.size, r.text_crc32) for r in odd_rows) == Counter((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in ODD)
    assert sharding.shard_documents(empty).count() == 0


def test_sharding_opens_nodes_until_cuts_are_exact(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROOT_BITS", 2)
    monkeypatch.setattr(sharding, "FANOUT_BITS", 3)
    rows = [((i * 0x9E3779B97F4A7C15 + 2**63) % 2**64 - 2**63, 1 + i % 9) for i in range(300)]
    cuts = sharding.minimax_cuts(spark.createDataFrame(rows, "k long, s long"), "k", "s", 5)
    held = Counter()
    for k, s in rows:
        held[sum(k >= c for c in cuts)] += s
    ordered = [s for _, s in sorted(rows)]

    def fits(capacity):
        n, own = 1, 0
        for s in ordered:
            n, own = (n, own + s) if own + s <= capacity else (n + 1, s)
        return n <= 5

    assert fits(max(held.values())) and not fits(max(held.values()) - 1)
