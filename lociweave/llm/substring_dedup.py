"""Substring dedup: relative Lempel-Ziv factors of documents against an index of reference blocks.

A window is a run of `window` words.  Each window names an anchor, the run of a third as many words in it that has the smallest
hash (the leftmost of equals), so windows of one text have their anchor in one place wherever they are.  A block is a
run of windows with one anchor; a document is cut into some 5 blocks a hundred words, by its own words alone.

1. The reference index has every anchor that two documents hold, with its smallest document.  Blocks with other anchors have no
   repeated window and go.
2. Parsing: a block that the index holds whole, words and all, from a document of a smaller id is matched whole, and a factor goes on
   as long as the next block is matched too.  A factor has `window` words or more, so all it covers is repeated.
3. Factor boundaries: where documents part from each other, blocks of one anchor differ.  Of each such block, the window
   hashes are written once, at its smallest document, and equal windows of different blocks are met by hash: the index knows the smallest
   document of each, so no window that a whole-block match passes over is lost.

Documents stay where they are and are read twice, the second time through a bit filter of bounded size.  What is shuffled are blocks (three
hashes for some eighteen words), then rows of repeated blocks and windows only.  No pairs of documents are made: a group of any
number of copies costs a row a block, and keys that many rows have are broadcast with their one row.

Windows and blocks are known by 128 bits of hashes that are mixed word by word; with n windows in all, some two different
ones are taken for equal with a chance of about n^2 / 2^129.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.llm.hot_join import join_counted
from lociweave.llm.kernels import WHITE, Words, give_back, mix, slices
from lociweave.llm.row_keys import LEAST_WORDS, MOST_WORDS, PACKED, packed_words
from lociweave.storage import drop, written

_ORDER = np.uint64(0x9FB21C651E98DF25)
#: Two hashes that have nothing in common but the words.
_SALTS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))
CUTS = "array<struct<at: long, n: long, source: long>>"
RESULT = "struct<n_words: long, n_removed: long, text: string, factors: array<struct<start: long, stop: long, source: long>>>"


def run_hashes(words: np.ndarray, sizes: list[int], salt: np.uint64) -> list[np.ndarray]:
    """For each size, the hashes of all runs of so many word hashes: runs of 1, 2, 4, ... words are joined, each time mixed."""
    powers, length = {1: mix(words ^ salt)}, 1
    while 2 * length <= min(max(sizes), len(words)):
        half = powers[length]
        powers[2 * length] = mix(half[:-length] * _ORDER + half[length:])
        length *= 2
    out = []
    for size in sizes:
        n, at, total = len(words) - size + 1, 0, None
        for length in sorted(powers, reverse=True) if n > 0 else ():
            while at + length <= size:
                part = powers[length][at : at + n]
                total, at = part if total is None else mix(total * _ORDER + part), at + length
        out.append(total if total is not None else np.zeros(0, np.uint64))
    return out


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of values[i : i + width], the leftmost of equals, for every i."""
    best, length = np.arange(len(values)), 1
    pick = lambda a, b: np.where(values[b] < values[a], b, a)
    while 2 * length <= width:
        best, length = pick(best[:-length], best[length:]), 2 * length
    rest = width - length
    return pick(best[:-rest], best[rest:]) if rest else best


class Blocks:
    """Blocks of the texts of one slice: row, first word in the row, number of windows, anchor and digest."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int):
        found = Words(data, offsets, WHITE, lower=False)
        hashed, gram = found.hashes(), max(1, window // 3)
        self.anchor, (self.wa, grams), (self.wb,) = np.zeros(0, np.uint64), run_hashes(hashed, [window, gram], _SALTS[0]), run_hashes(hashed, [window], _SALTS[1])
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(found.rows))
        windows = np.flatnonzero(row[: len(self.wa)] == row[window - 1 :]) if len(self.wa) else np.zeros(0, np.int64)
        place = leftmost_least(grams, window - gram + 1)[windows] if len(windows) else windows
        begins = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(windows) else windows
        self.first = windows[begins]
        self.n = np.diff(np.append(begins, len(windows)))
        last = self.first + self.n - 1
        self.anchor = grams[place[begins]] if len(windows) else self.anchor
        self.row = row[self.first] if len(windows) else windows
        self.at = self.first - found.rows[self.row]
        size = self.n.astype(np.uint64)
        self.a = mix(mix(self.wa[self.first] * _ORDER + self.wa[last]) ^ size)
        self.b = mix(mix(self.wb[self.first] * _ORDER + self.wb[last]) ^ size)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def blocks_of(texts: DataFrame, window: int) -> DataFrame:
    """(anchor, a, b, doc_id, own, at, n) of every block of texts (doc_id, own, text)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in slices(batch.column(2)):
                made = Blocks(data, offsets, window)
                if len(made.row):
                    rows = pa.array(made.row + first)
                    yield pa.RecordBatch.from_arrays(
                        [_long(made.anchor), _long(made.a), _long(made.b), batch.column(0).take(rows), batch.column(1).take(rows), _long(made.at), _long(made.n)],
                        names=["anchor", "a", "b", "doc_id", "own", "at", "n"],
                    )

    return texts.select("doc_id", "own", "text").mapInArrow(read, "anchor long, a long, b long, doc_id long, own long, at long, n long")


def _place(code: Column, words: int) -> tuple[Column, Column]:
    """(word, bit) of a hash in a filter of so many words of 64 bits."""
    return F.pmod(F.shiftright(code, 6), F.lit(words)).alias("word"), code.bitwiseAND(63).cast("int").alias("bit")


class KeyFilter:
    """A bit filter of 64-bit hashes, of 16 bits a key and MOST_WORDS words at most."""

    def __init__(self, codes: DataFrame, code: str, n: int):
        self.words = min(MOST_WORDS, max(LEAST_WORDS, 1 << (n // 4).bit_length()))
        bits = codes.select(*_place(F.col(code), self.words)).groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
        self.table = written(packed_words(bits), "filter")

    def passing(self, rows: DataFrame, code: Column) -> tuple[DataFrame, DataFrame]:
        """The rows whose code may be among the keys, and the others."""
        tested = rows.select("*", *[c.alias(f"_{k}") for k, c in zip(("word", "bit"), _place(code, self.words), strict=True)])
        met = tested.join(F.broadcast(self.table), F.expr(f"_word div {PACKED}") == self.table["block"], "left")
        maybe = F.expr(f"coalesce(getbit(packed[cast(_word % {PACKED} AS int)], _bit) = 1, false)")
        return met.where(maybe).select(*rows.columns), met.where(~maybe).select(*rows.columns)

    def bits(self) -> np.ndarray:
        """The filter as numbers: at most 64 MB."""
        out = np.zeros((self.words // PACKED, PACKED), np.int64)
        held = self.table.toArrow()
        if held.num_rows:
            packed = held.column("packed").combine_chunks()
            out[held.column("block").to_numpy()] = packed.flatten().to_numpy().reshape(-1, PACKED)
        return out.ravel()


def _holder(a: np.ndarray, b: np.ndarray, doc_ids: np.ndarray) -> np.ndarray:
    """Hash of a block and the document that it is in; `_holder_column` is the same in SQL terms."""
    return a ^ mix(b + doc_ids.view(np.uint64))


def boundary_windows(texts: DataFrame, parted: DataFrame, n: int, window: int) -> DataFrame:
    """(wa, wb, doc_id, own, at): the windows of the blocks of texts that are among parted (code), of n rows, or may be.

    A block that the filter lets pass without being there adds true windows of its document, which changes no result.
    """
    keep = KeyFilter(parted, "code", n)
    shared = texts.sparkSession.sparkContext.broadcast(keep.bits())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, _, data, offsets in slices(batch.column(2)):
                made = Blocks(data, offsets, window)
                code = _holder(made.a, made.b, ids[made.row + first]).view(np.int64)
                hit = np.flatnonzero(held[(code >> 6) % len(held)].view(np.uint64) >> (code & 63).astype(np.uint64) & np.uint64(1))
                if not len(hit):
                    continue
                n = made.n[hit]
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(made.first[hit], n) + step
                rows = pa.array(np.repeat(made.row[hit], n) + first)
                yield pa.RecordBatch.from_arrays(
                    [_long(made.wa[at]), _long(made.wb[at]), batch.column(0).take(rows), batch.column(1).take(rows), _long(np.repeat(made.at[hit], n) + step)],
                    names=["wa", "wb", "doc_id", "own", "at"],
                )

    return texts.select("doc_id", "own", "text").mapInArrow(read, "wa long, wb long, doc_id long, own long, at long")


def _with_holder(parted: DataFrame) -> DataFrame:
    """parted (a, b, doc_id) as distinct (code)."""

    @F.arrow_udf("long")
    def code(a: pa.Array, b: pa.Array, doc_id: pa.Array) -> pa.Array:
        a, b, ids = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b, doc_id))
        return pa.array(_holder(a.view(np.uint64), b.view(np.uint64), ids).view(np.int64))

    return parted.select(code("a", "b", "doc_id").alias("code"))


def repeated_windows(texts: DataFrame, window: int) -> DataFrame:
    """(doc_id, own, cuts): runs of windows (first word, number, a smaller document) that also start in a smaller document.

    texts: doc_id, own, text without nulls in doc_id and text; documents without such a window are left out.
    """
    blocks = written(blocks_of(texts, window), "blocks")
    ids = F.min("doc_id").alias("source"), F.max("doc_id").alias("_last")
    anchors = blocks.groupBy("anchor").agg(*ids, (F.min("a") != F.max("a")).alias("parted"), F.count("*").alias("_n"))
    index = written(anchors.where("source < _last").drop("_last"), "index")
    kept = KeyFilter(index, "anchor", index.count())
    shared = written(join_counted(kept.passing(blocks, F.col("anchor"))[0], index, ["anchor"]), "shared")
    drop(blocks)
    # blocks whose anchor has one text everywhere are matched by the anchor's smallest document
    alike = shared.where("NOT parted")
    varied = shared.where("parted").drop("source", "parted", "anchor")
    kinds = written(varied.groupBy("a", "b").agg(F.min("doc_id").alias("source"), F.count("*").alias("_n")), "kinds")
    matched = join_counted(varied, kinds, ["a", "b"])
    run = ["doc_id", "own", "at", "n", "source"]
    whole = alike.select(run).unionByName(matched.select(run)).where("source < doc_id")
    firsts = written(_with_holder(kinds.select("a", "b", F.col("source").alias("doc_id"))), "firsts")
    windows = written(boundary_windows(texts, firsts, firsts.count(), window), "windows")
    met = windows.groupBy("wa", "wb").agg(*ids, F.count("*").alias("_n")).where("source < _last").drop("_last")
    edges = join_counted(windows, written(met, "met"), ["wa", "wb"]).where("source < doc_id")
    cuts = whole.unionByName(edges.select("doc_id", "own", "at", F.lit(1).cast("long").alias("n"), "source"))
    return written(cuts.groupBy("doc_id", "own").agg(F.collect_set(F.struct("at", "n", "source")).alias("cuts")), "cuts")


def _parse(texts: pa.Array, cuts: pa.Array, window: int) -> pa.Array:
    """RESULT of each text without the words that its cuts cover."""
    begins = np.concatenate([[0], np.cumsum(cuts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
    at, n, source = (f.to_numpy(zero_copy_only=False).astype(np.int64) for f in cuts.flatten().flatten())
    counts, gone, bodies, factors = [], [], [], []
    for first, last, data, offsets in slices(texts):
        found = Words(data, offsets, WHITE, lower=False)
        cover = np.zeros(len(found.starts) + 1, np.int64)
        for k in range(last - first):
            own = slice(begins[first + k], begins[first + k + 1])
            start, stop = at[own], at[own] + n[own] - 1 + window
            np.add.at(cover, found.rows[k] + start, 1)
            np.add.at(cover, found.rows[k] + stop, -1)
            factors.append(greedy_factors(start, stop, source[own]))
        keep = np.cumsum(cover[:-1]) == 0
        words = np.concatenate([[0], np.cumsum(keep)])
        kept_before = words[found.rows]
        counts.append(np.diff(found.rows))
        gone.append(np.diff(found.rows) - np.diff(kept_before))
        marks = np.zeros(len(data) + 1, np.int64)
        marks[found.starts[keep]] += 1
        np.add.at(marks, found.ends[keep], -1)
        inside = np.cumsum(marks[:-1]) > 0
        row = np.searchsorted(found.rows, np.flatnonzero(keep), "right") - 1
        later = np.arange(len(row)) > kept_before[row]
        gaps = found.starts[keep][later] - 1
        out = data.copy()
        out[gaps], inside[gaps] = 0x20, True
        bounds = np.concatenate([[0], np.cumsum(inside)])[offsets]
        raw = out[inside].tobytes()
        bodies += [raw[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    give_back()
    factor = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("source", pa.int64())])
    flat = np.concatenate([np.zeros(0, np.int64), *counts]), np.concatenate([np.zeros(0, np.int64), *gone])
    columns = [pa.array(flat[0]), pa.array(flat[1]), pa.array(bodies, pa.binary()).cast(pa.string()), pa.array(factors, pa.list_(factor))]
    return pa.StructArray.from_arrays(columns, names=["n_words", "n_removed", "text", "factors"])


def greedy_factors(start: np.ndarray, stop: np.ndarray, source: np.ndarray) -> list[tuple[int, int, int]]:
    """(first word, end, a document that holds it) of the parse: from the left, a factor goes on while the next match has its source."""
    out: list[tuple[int, int, int]] = []
    for k in np.lexsort((stop, start)).tolist():
        a, b, s = int(start[k]), int(stop[k]), int(source[k])
        if out and out[-1][2] == s and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), s)
        else:
            out.append((a, b, s))
    return out


def remove_repeats(docs: DataFrame, window: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with n_words, n_removed, kept_text and factors: each text without the words of windows that a smaller document holds.

    A word goes if a run of `window` words with it in it also occurs in a row of a smaller doc_id, as the input has
    them.  kept_text are the words that stay, joined by one space; factors are the parsed stretches that went (first word, end, source
    document; they may overlap).  A null text has no words and an empty kept text; a row with a null doc_id is no source
    and loses nothing; rows of one doc_id do not repeat each other.  All rows and columns of docs come back (a column with one
    of the names above is replaced); texts shorter than a window are kept.
    """
    body, own = F.col(f"`{text}`").cast("string"), F.xxhash64(F.col(f"`{text}`").cast("string"))
    number = F.col(f"`{doc_id}`").cast("long")
    texts = docs.select(number.alias("doc_id"), own.alias("own"), body.alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    cuts = repeated_windows(texts, window)
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), number.alias("_doc"), own.alias("_own"))
    key = F.xxhash64("doc_id", "own")
    touched, whole = KeyFilter(cuts.select(key.alias("code")), "code", cuts.count()).passing(held, F.xxhash64("_doc", "_own"))
    met = touched.join(cuts, (F.col("_doc") == F.col("doc_id")) & (F.col("_own") == F.col("own")), "left").select("_row", "cuts")
    rows = met.unionByName(whole.select("_row", F.lit(None).cast(CUTS).alias("cuts")))

    @F.arrow_udf(RESULT)
    def parse(texts: pa.Array, cuts: pa.Array) -> pa.Array:
        return _parse(texts, cuts, window)

    made = {"n_words": "n_words", "n_removed": "n_removed", "kept_text": "text", "factors": "factors"}
    parsed = rows.select("_row", parse(F.col(f"_row.`{text}`").cast("string"), F.coalesce("cuts", F.array().cast(CUTS))).alias("_made"))
    kept = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in made]
    return parsed.select(*kept, *[F.col(f"_made.{k}").alias(name) for name, k in made.items()])
