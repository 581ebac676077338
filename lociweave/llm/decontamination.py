"""Benchmark decontamination: prefix-filtered set join of benchmark windows with documents.

An item's windows are its runs of `window` words (all its words where it has fewer).  A window occurs in a document only
if each of its shingles does, so one shingle is the necessary prefix, and the rarest makes the fewest candidates:

1. document frequencies of the benchmark's shingles are counted over all documents, and the shingles of each window are
   ordered by rarity; a window with a shingle that no document has is left out;
2. documents are joined with the windows on that rarest shingle; the place of the shingle in the window fixes where the
   window must start, candidates that do not fit between the ends of the text are dropped, and the rest are compared word
   for word.

Documents stay where they are.  They are read through bit filters of the shingles that matter, of BITS bits a shingle and
MOST_BITS at most, so that what is sent is bounded whatever the benchmark's size, and only what passes becomes rows: a
shingle, or a place with the words around it.  Those rows and the windows are joined as tables, by broadcast or by a
shuffle as their sizes tell Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.llm.kernels import NON_ALNUM, Words, shingles, slices
from lociweave.llm.row_keys import without
from lociweave.storage import written

SHINGLE_WORDS = 5
BITS, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 29
SPANS = "array<struct<start: long, stop: long>>"


def _codes(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(word position, hash) of the runs of `size` words; runs of other sizes than SHINGLE_WORDS are kept apart."""
    at, codes = shingles(words, rows, size)
    return at, codes if size == SHINGLE_WORDS else codes ^ np.uint64(size)


def item_windows(benchmark: DataFrame, window: int, item_id: str, item_text: str) -> DataFrame:
    """(item, id, n, text, grams): every window of every item; text: its words joined by spaces, grams: (code, size, place)."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("string").alias("text"))
    schema = "item string, id binary, n int, text string, grams array<struct<code: long, size: int, place: int>>"
    gram = pa.struct([("code", pa.int64()), ("size", pa.int32()), ("place", pa.int32())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for first, last, data, offsets in slices(batch.column(1)):
                found = Words(data, offsets, NON_ALNUM)
                hashed, out = found.hashes(), []
                for r in range(last - first):
                    lo, hi = int(found.rows[r]), int(found.rows[r + 1])
                    words = [found.data[a:b].tobytes() for a, b in zip(found.starts[lo:hi], found.ends[lo:hi], strict=True)]
                    n = min(window, len(words))
                    size = min(SHINGLE_WORDS, n)
                    codes = _codes(hashed[lo:hi], np.array([0, hi - lo]), size)[1].view(np.int64).tolist() if n else []
                    item = batch.column(0)[row + r].as_py()
                    for at in range(len(words) - n + 1 if n else 0):
                        text = b" ".join(words[at : at + n])
                        grams = [{"code": codes[at + p], "size": size, "place": p} for p in range(n - size + 1)]
                        out.append((item, hashlib.blake2b(text, digest_size=16).digest(), n, text.decode(), grams))
                row += last - first
                columns = list(zip(*out, strict=True)) or [()] * 5
                types = (pa.string(), pa.binary(), pa.int32(), pa.string(), pa.list_(gram))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["item", "id", "n", "text", "grams"])

    return rows.where("item IS NOT NULL AND text IS NOT NULL").mapInArrow(read, schema)


class BitFilter:
    """Bits of 64-bit codes, and the sizes of their shingles; what is broadcast holds MOST_BITS bits at most."""

    def __init__(self, codes: DataFrame):
        """codes: distinct (size, code)."""
        self.sizes = sorted(r["size"] for r in codes.select("size").distinct().collect())  # SHINGLE_WORDS rows at most
        words = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS * codes.count()).bit_length())) // 64
        self.bits = np.zeros(words, np.int64)
        marked = codes.select(F.pmod(F.shiftrightunsigned("code", 6), F.lit(words)).alias("word"), F.col("code").bitwiseAND(63).cast("int").alias("bit"))
        for row in marked.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toLocalIterator():
            self.bits[row["word"]] = row["bits"]

    def passing(self, hashed: np.ndarray, rows: np.ndarray):
        """(size, word positions, codes) of the shingles that may be among the codes."""
        held = self.bits.view(np.uint64)
        for size in self.sizes:
            at, codes = _codes(hashed, rows, size)
            word = ((codes >> np.uint64(6)) % np.uint64(len(held))).astype(np.int64)
            hit = (held[word] >> (codes & np.uint64(63)) & np.uint64(1)).astype(bool)
            yield size, at[hit], codes[hit]


def frequencies(texts: DataFrame, grams: DataFrame) -> DataFrame:
    """(code, size, df): in how many of texts (text) each of grams (code, size) occurs; none is left out."""
    shared = texts.sparkSession.sparkContext.broadcast(BitFilter(grams))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, data, offsets in slices(batch.column(0)):
                found = Words(data, offsets, NON_ALNUM)
                for size, at, codes in shared.value.passing(found.hashes(), found.rows):
                    row = np.searchsorted(found.rows, at, "right") - 1
                    order = np.lexsort((codes, row))
                    row, codes = row[order], codes[order]
                    once = np.ones(len(row), bool)
                    once[1:] = (row[1:] != row[:-1]) | (codes[1:] != codes[:-1])
                    own = codes[once].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.full(len(own), size, np.int32))], names=["code", "size"])

    counted = texts.select("text").mapInArrow(read, "code long, size int").groupBy("code", "size").agg(F.count("*").alias("df"))
    return grams.join(counted, ["code", "size"])


def candidates(texts: DataFrame, prefixes: DataFrame, window: int) -> DataFrame:
    """(key, code, size, base, at, words): places in texts (key, text) of shingles that may be among prefixes (code, size).

    words: the words within reach of a window around the place, joined by spaces; base: number of the first of them in
    the text, at: where in them the shingle starts.
    """
    shared = texts.sparkSession.sparkContext.broadcast(BitFilter(prefixes))
    schema = "key binary, code long, size int, base long, at int, words string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "code", "size", "base", "at", "words"]
        for batch in batches:
            keys = batch.column(0)
            for first, _, data, offsets in slices(batch.column(1)):
                found = Words(data, offsets, NON_ALNUM)
                raw = found.data.tobytes()
                for size, at, codes in shared.value.passing(found.hashes(), found.rows):
                    row = np.searchsorted(found.rows, at, "right") - 1
                    low = np.maximum(found.rows[row], at - (window - size))
                    high = np.minimum(found.rows[row + 1], at + window)
                    starts, ends = found.starts.tolist(), found.ends.tolist()
                    words = [b" ".join([raw[starts[w] : ends[w]] for w in range(a, b)]).decode() for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(row + first)), pa.array(codes.view(np.int64)), pa.array(np.full(len(row), size, np.int32)), pa.array(low - found.rows[row]),
                         pa.array((at - low).astype(np.int32)), pa.array(words, pa.string())], names=names
                    )

    return texts.select("key", "text").mapInArrow(read, schema)


def _key(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def text_hits(docs: DataFrame, benchmark: DataFrame, window: int, text: str, item_id: str, item_text: str) -> DataFrame:
    """(_key, spans, items): what the texts of docs have of the benchmark; texts without a hit are left out."""
    texts = docs.select(F.col(text).cast("string").alias("text")).where("text IS NOT NULL")
    every = written(item_windows(benchmark, window, item_id, item_text), "windows")
    windows = every.groupBy("id").agg(F.first("n").alias("n"), F.first("text").alias("window"), F.first("grams").alias("grams"))
    grams = windows.select("id", F.explode("grams").alias("g")).select("id", "g.*")
    counted = frequencies(texts, written(grams.select("code", "size").distinct(), "grams"))
    # rarest first; a window with a shingle of no document has a row less than shingles
    order = F.struct("df", "code", "place", "size")
    rarest = grams.join(counted, ["code", "size"]).groupBy("id").agg(F.min(order).alias("r"), F.count("*").alias("known"))
    prefixes = windows.join(rarest, "id").where("known = size(grams)").select("id", "n", F.split("window", " ").alias("window"), "r.code", "r.size", "r.place")
    prefixes = written(prefixes, "prefixes")
    places = candidates(texts.select(_key(F.col("text")).alias("key"), "text"), prefixes.select("code", "size").distinct(), window)
    begin = F.col("at") - F.col("place")
    words = F.split("words", " ")
    met = places.join(prefixes, ["code", "size"]).where((begin >= 0) & (begin + F.col("n") <= F.size(words)))
    same = met.where(F.slice(words, begin + 1, F.col("n")) == F.col("window"))
    start = F.col("base") + begin
    found = written(same.select("key", "id", start.alias("start"), (start + F.col("n")).alias("stop")).distinct(), "occurrences")
    spans = found.groupBy("key").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    items = found.select("key", "id").distinct().join(every.select("id", "item").distinct(), "id").groupBy("key").agg(F.collect_set("item").alias("items"))
    return written(spans.join(items, "key").withColumnRenamed("key", "_key"), "hits")


def _word_count(text: Column) -> Column:
    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        counts = [np.diff(Words(data, offsets, NON_ALNUM).rows) for *_, data, offsets in slices(texts)]
        return pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64))

    return count(text)


def _covered(spans: Column) -> Column:
    """Words in the union of the spans."""
    return F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("until")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], a["until"]))).alias("n"),
            F.greatest(a["until"], s["stop"]).alias("until"),
        ),
        lambda a: a["n"],
    )


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """docs with n_words, hit_spans (word positions of window occurrences), n_hit and item_ids (strings, sorted).

    Words are runs of digits, ASCII letters (A-Z lower-cased) and non-ASCII characters.  Null texts have no words, items
    without words no windows; items without an id are ignored, and items of one id are one item.  All rows and columns
    of docs come back (a column of the names above is replaced); an empty benchmark hits nothing.  Rows of one text have
    the same hits: texts are told apart by their SHA-256.
    """
    hits = text_hits(docs, benchmark, window, text, item_id, item_text)
    body = F.col(text).cast("string")
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_row{i}") for i, c in enumerate(docs.columns)], _word_count(body).alias("_n"), _key(body).alias("_own"))
    met = rows.join(hits, rows["_own"] == hits["_key"], "left")
    spans = F.array_sort(F.coalesce("spans", F.array().cast(SPANS)))
    made = {"n_words": F.col("_n"), "hit_spans": spans, "n_hit": _covered(spans), "item_ids": F.array_sort(F.coalesce("items", F.array().cast("array<string>")))}
    kept = [F.col(f"_row{i}").alias(c) for i, c in enumerate(docs.columns) if c not in made]
    return met.select(*kept, *[c.alias(n) for n, c in made.items()])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of docs in which no benchmark window occurs, with their own columns alone."""
    hits = text_hits(docs, benchmark, window, "text", "item_id", "text").select("_key")
    rows = docs.select(F.struct("*").alias("_row"), _key(F.col("text").cast("string")).alias("_own"))
    return without(rows, hits, [("_own", "_key")]).select("_row.*")
