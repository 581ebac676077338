"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often they are linked.

Both tokenizers' tokens of a text are cut at the bytes where both end.  Every byte gets a label: a token of neither, of A, of B
or of both ends with it.  A regular expression scans the labels and extracts the spans up to each byte where both end; the counts of
labels in a span say how many tokens of either are in its group.  All pairs of an A and a B token of a group are linked.

Texts are cut into units first, before a space between two characters that are no spaces, where a token of neither tokenizer
reaches across: A splits words there before it merges, and B has no piece with a space behind another character.  Both are read off the
tokenizers when they are loaded; where either does not hold, a text is one unit.  A unit's tokens and groups are kept by
the worker, up to MOST_BYTES of units, so that common words are encoded and scanned once and not at each place.  New units are
encoded JOINED at a time, as a text that would be cut into them.

A text leaves the task as one row with its distinct linked id pairs and their numbers.  Document counts of pairs are added up in the tasks before
they are shuffled.  The HOT most frequent pairs are broadcast to sum each row's counts; pairs beyond these, which few documents have, are joined by a shuffle.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain, pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.llm.files import open_file
from lociweave.llm.kernels import give_back
from lociweave.storage import written

TOKENIZER_A, TOKENIZER_B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: So many pairs are broadcast at most, of 17 bytes each.
HOT = 1 << 18
#: Units that a worker keeps, and texts that it takes at once.
MOST_BYTES, TEXT_BYTES = 1 << 26, 1 << 21
#: New units that are encoded as one text.
JOINED = 256
#: Groups with more links than this have their pairs counted by distinct ids.
MOST_LINKS = 1 << 12
#: Before these a text may be cut at a space: no white space, whatever the Unicode version, is among them.
_CUT = re.compile("(?<=[^ ]) (?=[!-~À-ᙿぁ-﫿])")
#: A unit that may stand between two cuts.
_INNER = re.compile("[!-~À-ᙿぁ-﫿](?:.*[^ ])?", re.DOTALL).fullmatch
_SPACE = "▁"
_GROUP = re.compile(rb"[^x]*x", re.DOTALL)
_LABELS = np.frombuffer(b"nabx", np.uint8)
#: The worker's last pair of tokenizers, by the digest of their files.
_loaded: dict[str, Aligner] = {}
FIELDS = {"doc_id": "long", "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups": "string", "pairs": "array<long>", "links": "array<long>"}
ROW = ", ".join(f"{k} {v}" for k, v in FIELDS.items())


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints, else the next free code point."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(others)}


def aligned(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens of A, tokens of B, end) of each group, from the bytes at which the tokens of each end; the last bytes are the same."""
    if not len(a_ends):
        return (np.zeros(0, np.int64),) * 3
    marks = np.zeros(int(a_ends[-1]), np.uint8)
    marks[a_ends - 1] += 1
    marks[b_ends - 1] += 2
    spans = _GROUP.findall(_LABELS[marks].tobytes())
    stops = np.cumsum(np.fromiter(map(len, spans), np.int64, len(spans)))
    # a label's number in a span: those up to its end less those up to the end before
    counted = [np.diff(np.searchsorted(ends, stops, "right"), prepend=0) for ends in (a_ends, b_ends)]
    return *counted, stops


class Aligner:
    """Two tokenizers and the units that they have aligned."""

    def __init__(self, a: bytes, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b)
        letters, vocabulary = byte_letters(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.a_bytes[k] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(_SPACE, " ").encode() for k, p in enumerate(pieces)]
        self.n_b = len(pieces)
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in spelling], np.int64) for spelling in (self.a_bytes, self.b_bytes))
        #: Each id as text with what may follow it: "," or "|" behind one of A, "," or ";" behind one of B.
        self.marked = [f"{k}{mark}".encode() for n, marks in ((len(self.a_bytes), ",|"), (self.n_b, ",;")) for k in range(n) for mark in marks]
        self.marked_sizes = np.array([len(m) for m in self.marked], np.int64)
        made = json.loads(a)
        split = made["pre_tokenizer"] or {}
        words = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not made["normalizer"]
        plain = all(t["special"] for t in made["added_tokens"])
        self.cuts = words and plain and not any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in pieces)
        self.cut = _CUT.split if self.cuts else lambda text: [text]
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.size = 0
        self.counts = array("q")  # of each unit: tokens of A, of B, groups, links, and whether the tokens spell it
        self.groups: list[bytes] = []
        self.begins, self.pairs, self.links = array("q", [0]), array("q"), array("q")

    def learn(self, units: set[str]) -> None:
        """Encode and align the units that are new, all at once: every unit ends with a byte where both end, so that labels can follow each other."""
        new = [u for u in units if u not in self.index]
        if not new:
            return
        inner, lone = [], []
        for u in new:
            (inner if self.cuts and _INNER(u) else lone).append(u)
        good, bad, a, b = self._encoded([inner[k : k + JOINED] for k in range(0, len(inner), JOINED)] + [[u] for u in lone])
        until = np.cumsum(np.fromiter((len(u.encode()) + 1 for u in good), np.int64, len(good)))
        in_a, in_b, stops = aligned(np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b]))
        unit = np.searchsorted(until, stops)  # of each group, among the good ones
        pair, links, owner = self._linked(a, b, in_a, in_b, unit)
        facts = np.zeros((len(new), 5), np.int64)
        for k, each in enumerate((in_a, in_b, np.ones(len(unit)))):
            facts[: len(good), k] = np.bincount(unit, each, len(good))
        facts[: len(good), 3], facts[: len(good), 4] = np.bincount(owner, links, len(good)), 1
        self.groups += self._shown(a, b, in_a, in_b, unit, len(good)) + [b""] * len(bad)
        self.index.update(zip(chain(good, bad), range(len(self.index), len(self.index) + len(new)), strict=True))
        self.counts.frombytes(facts.tobytes())
        self.begins.frombytes((np.cumsum(np.bincount(owner, minlength=len(new))) + len(self.pairs)).tobytes())
        self.pairs.frombytes(pair.tobytes())
        self.links.frombytes(links.tobytes())
        self.size += (int(until[-1]) if good else 0) + sum(len(u.encode()) for u in bad) + 128 * len(new) + 16 * len(pair) + 10 * len(a)

    def _encoded(self, chunks: list[list[str]]) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
        """(good, bad, ids of A, ids of B): units that their tokens spell, those that they do not, and the tokens of the good ones in their order.

        The units of a chunk are encoded as one text; where its tokens do not spell it, each unit is encoded by itself.
        """
        texts = [" ".join(own) for own in chunks]
        ids = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], self.b.encode(texts, num_threads=1)
        spells = lambda own, spelling, text: b"".join(map(spelling.__getitem__, own)) == text
        raw = (f" {t}".encode() for t in texts)
        spelled = [spells(x, self.a_bytes, t) and spells(y, self.b_bytes, t) for x, y, t in zip(*ids, raw, strict=True)]
        good = list(chain.from_iterable(own for own, ok in zip(chunks, spelled, strict=True) if ok))
        a, b = (np.fromiter(chain.from_iterable(x for x, ok in zip(own, spelled, strict=True) if ok), np.int64) for own in ids)
        failed = [own for own, ok in zip(chunks, spelled, strict=True) if not ok]
        bad = [own[0] for own in failed if len(own) == 1]
        again = [[u] for own in failed if len(own) > 1 for u in own]
        if again:
            more, worse, *rest = self._encoded(again)
            good, bad, a, b = good + more, bad + worse, np.concatenate([a, rest[0]]), np.concatenate([b, rest[1]])
        return good, bad, a, b

    def _linked(self, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, links, unit): the distinct linked pairs of each unit, units in their order; in_a, in_b: how many tokens a group has."""
        from_a, from_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        some = np.flatnonzero(in_a * in_b <= MOST_LINKS)
        n = (in_a * in_b)[some]
        each = np.repeat(some, n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        owner, pair = [unit[each]], [a[from_a[each] + k // in_b[each]] * self.n_b + b[from_b[each] + k % in_b[each]]]
        times = [np.ones(len(each), np.int64)]
        for g in np.flatnonzero(in_a * in_b > MOST_LINKS).tolist():  # a long group's pairs are counted by distinct ids
            xs, ys = Counter(a[from_a[g] :][: in_a[g]].tolist()), Counter(b[from_b[g] :][: in_b[g]].tolist())
            found = [(p * self.n_b + q, m * n) for p, m in xs.items() for q, n in ys.items()]
            pair.append(np.array([p for p, _ in found]))
            times.append(np.array([m for _, m in found]))
            owner.append(np.full(len(found), unit[g]))
        owner, pair, times = map(np.concatenate, (owner, pair, times))
        span = len(self.a_bytes) * self.n_b
        key, back = np.unique(owner * span + pair, return_inverse=True)
        return key % span, np.bincount(back, times, len(key)).astype(np.int64), key // span

    def _shown(self, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, unit: np.ndarray, n: int) -> list[bytes]:
        """The groups of each of n units as text: tokens in group order, each with the mark that follows it."""
        last_a, last_b = np.cumsum(in_a) - 1, np.cumsum(in_b) - 1
        codes = np.empty(len(a) + len(b), np.int64)
        own_a, own_b = np.repeat(np.arange(len(in_a)), in_a), np.repeat(np.arange(len(in_b)), in_b)
        codes[np.arange(len(a)) + (last_b - in_b + 1)[own_a]] = 2 * a + (np.arange(len(a)) == last_a[own_a])
        codes[np.arange(len(b)) + (last_a + 1)[own_b]] = 2 * (len(self.a_bytes) + b) + (np.arange(len(b)) == last_b[own_b])
        shown = b"".join(map(self.marked.__getitem__, codes.tolist()))
        ends = np.concatenate([[0], np.cumsum(self.marked_sizes[codes])])[np.cumsum(np.bincount(unit, in_a + in_b, n).astype(np.int64))].tolist()
        return [shown[begin : end - 1] for begin, end in pairwise([0, *ends])]

    def rows(self, ids: list, texts: list[str]) -> pa.RecordBatch:
        """A row (FIELDS) for each text."""
        if self.size > MOST_BYTES:
            self.forget()
        units = [self.cut(t) if t else [] for t in texts]
        flat = list(chain.from_iterable(units))
        self.learn(set(flat))
        n = np.fromiter(map(len, units), np.int64, len(units))
        at = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        doc = np.repeat(np.arange(len(texts)), n)
        counts = np.array(self.counts, np.int64).reshape(-1, 5)
        spelled = np.bincount(doc, counts[at, 4] == 0, len(texts)) == 0
        sums = [np.where(spelled, np.bincount(doc, counts[at, k], len(texts)), 0).astype(np.int64) for k in range(4)]
        good = spelled[doc]
        key, times = np.unique(doc[good] * len(self.index) + at[good], return_counts=True)
        own, unit = key // max(len(self.index), 1), key % max(len(self.index), 1)
        begins = np.array(self.begins, np.int64)
        width = begins[unit + 1] - begins[unit]
        place = np.repeat(begins[unit], width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        span = len(self.a_bytes) * self.n_b
        key, back = np.unique(np.repeat(own, width) * span + np.array(self.pairs, np.int64)[place], return_inverse=True)
        links = np.bincount(back, np.array(self.links, np.int64)[place] * np.repeat(times, width), len(key)).astype(np.int64)
        offsets = pa.array(np.searchsorted(key, np.arange(len(texts) + 1) * span).astype(np.int32))
        shown = list(map(self.groups.__getitem__, at.tolist()))
        groups = [b";".join(shown[end - k : end]) if ok else b"" for end, k, ok in zip(np.cumsum(n).tolist(), n.tolist(), spelled.tolist(), strict=True)]
        listed = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (key % span, links)]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *map(pa.array, sums), pa.array(groups, pa.binary()).cast(pa.string()), *listed], names=list(FIELDS)
        )


def _aligner(a: bytes, b: bytes) -> Aligner:
    key = hashlib.sha256(a + b).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Aligner(a, b)
    return _loaded[key]


def _content(path: str) -> bytes:
    if "://" not in path:
        return Path(path).read_bytes()
    store, name = open_file(path)
    with store.open_input_stream(name) as stream:
        return stream.read()


def aligned_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a: str = TOKENIZER_A, b: str = TOKENIZER_B) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups, pairs and links of each row of docs.

    groups: `a1,a2|b1;a3|b2,b3`, ids of A and of B in their order; pairs: the distinct linked ids as a * (size of B's vocabulary) + b,
    ascending, and links how many token pairs of the text each is.  The files are read by the driver and broadcast (2 MB).
    A null or empty text, and one that the tokens of A or of B do not spell, has no tokens.
    """
    shared = docs.sparkSession.sparkContext.broadcast((_content(a), _content(b)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _aligner(*shared.value)
        for batch in batches:
            ids, texts, first, held = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0, 0
            for k, body in enumerate(texts):
                held += len(body or "")
                if held >= TEXT_BYTES or k == len(texts) - 1:
                    yield made.rows(ids[first : k + 1], texts[first : k + 1])
                    first, held = k + 1, 0
            give_back()

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(read, ROW)


def pair_counts(rows: DataFrame, n_b: int) -> DataFrame:
    """(pair, docs, best): how many of rows (pairs) hold a pair, and whether no pair of its A id is held by more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, docs = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(docs, pa.int64())], names=["pair", "docs"])

    counted = written(rows.select("pairs").mapInArrow(count, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs")), "pairs")
    a = F.expr(f"pair div {n_b}L")
    # a row for each id of A's vocabulary at most
    most = counted.groupBy(a.alias("_a")).agg(F.max("docs").alias("_most"))
    return written(counted.join(F.broadcast(most), a == F.col("_a")).select("pair", "docs", (F.col("docs") == F.col("_most")).alias("best")), "counts")


def count_links(rows: DataFrame, counts: DataFrame, hot: int = HOT) -> DataFrame:
    """(_row, n_best, count_sum) of rows (_row, pairs, links): links whose pair is the best of its A id, and all links' counts summed."""
    top = counts.orderBy(F.desc("docs"), "pair").limit(hot).toArrow().sort_by("pair")
    known = [top.column(c).to_numpy() for c in ("pair", "docs", "best")]
    shared = rows.sparkSession.sparkContext.broadcast(known)
    names = ["_row", "n_best", "count_sum", "cold", "cold_links"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, docs, best = shared.value
        for batch in batches:
            n = batch.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), n)
            own, links = (batch.column(k).flatten().to_numpy().astype(np.int64) for k in (1, 2))
            at = np.minimum(np.searchsorted(pair, own), max(len(pair) - 1, 0))
            hit = pair[at] == own if len(pair) else np.zeros(len(own), bool)
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], row[hit], links[hit] * best[at[hit]])
            np.add.at(sums[1], row[hit], links[hit] * docs[at[hit]])
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=batch.num_rows))]).astype(np.int32))
            listed = [pa.ListArray.from_arrays(offsets, pa.array(x[~hit])) for x in (own, links)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, sums), *listed], names=names)

    summed = rows.select("_row", "pairs", "links").mapInArrow(read, "_row long, n_best long, count_sum long, cold array<long>, cold_links array<long>")
    if top.num_rows < hot:
        return summed.select(*names[:3])
    summed = written(summed, "summed")
    rest = summed.select("_row", F.explode(F.arrays_zip("cold", "cold_links")).alias("c")).select("_row", F.col("c.cold").alias("pair"), F.col("c.cold_links").alias("n"))
    more = rest.join(counts, "pair").groupBy("_row").agg(F.sum(F.col("n") * F.col("best").cast("long")).alias("_best"), F.sum(F.col("n") * F.col("docs")).alias("_sum"))
    add = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
    return summed.join(more, "_row", "left").select("_row", add("n_best", "_best"), add("count_sum", "_sum"))


def align_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a: str = TOKENIZER_A, b: str = TOKENIZER_B, hot: int = HOT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each row of docs.

    A pair's count is the number of rows that hold it linked; repeated rows count each, and so do rows of one or no doc_id.
    n_best: links whose count is the highest of their A id, ties included; count_sum: all links' counts.  A text without tokens
    (see aligned_groups) has zeros and an empty groups_sha256; an empty table gives no rows.  Other columns are not read.
    """
    made = aligned_groups(docs, doc_id, text, a, b)
    digest = F.when(F.col("n_groups") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    rows = written(made.withColumn("groups_sha256", digest).drop("groups").withColumn("_row", F.monotonically_increasing_id()), "aligned")
    sums = count_links(rows, pair_counts(rows, _aligner(_content(a), _content(b)).n_b), hot)
    kept = rows.drop("pairs", "links")
    return kept.join(sums, "_row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
