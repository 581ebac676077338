"""Alignment of two tokenizers against whole texts encoded in one go, and rows of every odd kind."""

import hashlib
import random
from bisect import bisect_right
from collections import Counter
from itertools import accumulate
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from lociweave.llm import tokenizer_alignment
from lociweave.llm.queries import op11_tokenizer_alignment
from lociweave.llm.tokenizer_alignment import TOKENIZER_A, TOKENIZER_B, Aligner, align_documents, aligned

A = Tokenizer.from_file(TOKENIZER_A)
A.encode_special_tokens = True
B = SentencePieceProcessor(model_file=TOKENIZER_B)


HIDDEN = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b >= 174)]


def byte_of(letter):
    """The byte a letter of the byte-level vocabulary stands for."""
    return ord(letter) if ord(letter) < 256 else HIDDEN[ord(letter) - 256]


def piece_bytes(k):
    piece = B.id_to_piece(k)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(k) else piece.replace("▁", " ").encode()


def groups_of(text):
    """[(ids of A, ids of B)] of a whole text, by the byte offsets where both end."""
    if not text:
        return []
    raw = f" {text}".encode()
    a, b = A.encode(f" {text}", add_special_tokens=False).ids, B.encode(text)
    a_bytes = [bytes(map(byte_of, A.id_to_token(k))) for k in a]
    b_bytes = [piece_bytes(k) for k in b]
    if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return []
    a_ends, b_ends = list(accumulate(map(len, a_bytes))), list(accumulate(map(len, b_bytes)))
    ends = sorted({*a_ends} & {*b_ends})
    out = []
    for begin, end in zip([0, *ends[:-1]], ends, strict=True):
        pick = lambda ids, at, lo=begin, hi=end: ids[bisect_right(at, lo) : bisect_right(at, hi)]
        out.append((pick(a, a_ends), pick(b, b_ends)))
    return out


def plain(rows):
    found = [(i, groups_of(t)) for i, t in rows]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for _, groups in found]
    held = Counter(pair for own in links for pair in own)
    best = {}
    for (x, _), n in held.items():
        best[x] = max(n, best.get(x, 0))
    out = []
    for (i, groups), own in zip(found, links, strict=True):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((
            i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(own.values()),
            sum(n for p, n in own.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str)


def got(df, **options):
    return sorted((tuple(r) for r in align_documents(df, **options).collect()), key=str)


ODD = [
    (None, None), (1, None), (2, ""), (3, " "), (4, "   "), (5, " leading and trailing "), (6, "two  spaces   three"), (7, "line\n next\n\n  more \n"), (8, "a▁b"),
    (9, "<|endoftext|> and </s> and <unk> <0x41>"), (10, "的中文 文字 和 \U0001f600\U0001f600 emoji"), (11, " nbsp　wide  em"), (12, "it's we'll I'm' 'x 12 345"), (13, "\x00 \x1c \x85 odd"),
    (14, "same words same words"), (14, "same words same words"), (15, "word " * 3000), (16, "x" * 5000), (17, "é ไทย ال  ogham ᠎ mvs"), (18, "tab\t x \r\n y"),
]


@pytest.mark.parametrize("hot", [1 << 18, 5])
def test_equals_whole_texts(spark, hot):
    rng = random.Random(1)
    parts = [t for _, t in ODD[6:] if len(t) < 100] + ["the", "of", "The", ".", " ", "\n", "  ", "antidisestablishment", "été", "да"]
    rows = ODD + [(100 + k, rng.choice(["", " ", " "]).join(rng.choice(parts) for _ in range(rng.randint(1, 40)))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    df = df.withColumns({c: F.lit(1) for c in ("pairs", "links", "groups", "_row", "n_a", "docs", "best", "pair")})
    assert got(df, hot=hot) == plain(rows)


def test_query_equals_whole_texts(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op11_tokenizer_alignment(spark, SF).collect()), key=str) == plain(rows)


def test_empty_table(spark):
    out = align_documents(spark.createDataFrame([], "doc_id long, text string"))
    assert out.count() == 0 and out.columns[-1] == "groups_sha256"


def test_workers_forget_units(spark, monkeypatch):
    monkeypatch.setattr(tokenizer_alignment, "MOST_BYTES", 0)
    made = Aligner(Path(TOKENIZER_A).read_bytes(), Path(TOKENIZER_B).read_bytes())
    for _ in range(2):
        row = made.rows([1], ["some words here"]).to_pylist()[0]
        assert row["groups"] == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups_of("some words here"))
    assert len(made.index) == 3


def test_labels_cut_groups_where_both_end():
    made = aligned(np.array([3, 4, 6]), np.array([2, 4, 5, 6]))
    assert [x.tolist() for x in made] == [[2, 1], [2, 2], [4, 6]]
    assert [x.tolist() for x in aligned(*[np.zeros(0, np.int64)] * 2)] == [[], [], []]


def test_long_groups_are_counted_by_ids(spark, monkeypatch):
    rows = [(1, "été 的中 \U0001f600 naïve antidisestablishment"), (2, "的" * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(tokenizer_alignment, "MOST_LINKS", 1)
    made = Aligner(Path(TOKENIZER_A).read_bytes(), Path(TOKENIZER_B).read_bytes()).rows([1, 2], [t for _, t in rows]).to_pylist()
    for row, (_, text) in zip(made, rows, strict=True):
        want = Counter(x * B.get_piece_size() + y for a, b in groups_of(text) for x in a for y in b)
        assert dict(zip(row["pairs"], row["links"], strict=True)) == want
    assert got(df) == plain(rows)


def test_new_units_are_encoded_together():
    made = Aligner(Path(TOKENIZER_A).read_bytes(), Path(TOKENIZER_B).read_bytes())
    asked, real = [], made.a
    made.a = SimpleNamespace(encode_batch_fast=lambda texts, **options: asked.append(len(texts)) or real.encode_batch_fast(texts, **options))
    words = [f"{w}{k}" for k in range(300) for w in ("word", "été\n", "не")]
    # the first ends and starts with spaces and is encoded by itself; one unit is not spelled, so those beside it are encoded again
    texts = ["  " + " ".join(words) + "  ", "a▁b", "plain words"]
    for row, text in zip(made.rows([1, 2, 3], texts).to_pylist(), texts, strict=True):
        assert row["groups"] == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups_of(text))
    assert len(made.index) == 903 and asked[0] <= 6 and sum(asked) <= 6 + tokenizer_alignment.JOINED
