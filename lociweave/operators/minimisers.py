"""Minimisers of sequences: of each window of w stretches of k bases, the one with the smallest hash of its canonical code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lociweave.operators.bit_filter import passing
from lociweave.operators.stretches import overlapping

#: The order of codes: a product modulo a prime, of codes that are mixed first so that runs of one base do not come first.
PRIME, TIMES, MIXED = (1 << 31) - 1, 48271, 0x5DEECE66D
NONE = np.iinfo(np.int64).max


def digits_of(text: str, masked: bool) -> np.ndarray:
    """A, C, G, T as 0 to 3, all else as 4; masked: lower-case bases are all else."""
    table = np.full(256, 4, np.uint8)
    for k, base in enumerate(b"ACGT"):
        table[base] = k
        if not masked:
            table[base | 32] = k
    return table[np.frombuffer(text.encode("ascii", "replace"), np.uint8)]


def canonical_codes(digits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, reverse, order) of every stretch of k <= 31 bases.

    code: two bits a base, the smaller of the stretch and its reverse complement; reverse: the latter is smaller; order: what
    minimisers are chosen by, NONE where the stretch has another letter or is its own reverse complement.
    """
    n = len(digits) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
    there, back = np.zeros(n, np.int64), np.zeros(n, np.int64)
    clear = digits & 3
    for j in range(k):
        own = clear[j : j + n].astype(np.int64)
        there = there << 2 | own
        back |= (3 - own) << 2 * j
    other = np.concatenate([[0], np.cumsum(digits == 4)])
    code = np.minimum(there, back)
    order = ((code ^ MIXED) % PRIME) * TIMES % PRIME
    return code, back < there, np.where((other[k:] > other[:-k]) | (there == back), NONE, order)


def chosen(order: np.ndarray, w: int) -> np.ndarray:
    """Places of the smallest of every w orders in a row, the leftmost of equals; fewer than w orders are one window."""
    if not len(order):
        return np.zeros(0, np.int64)
    best = np.arange(max(1, len(order) - w + 1))
    for step in range(1, min(w, len(order))):
        after = np.arange(len(best)) + step
        best = np.where(order[after] < order[best], after, best)
    best = np.unique(best)
    return best[order[best] < NONE]


def minimisers(rows: DataFrame, name: str, seq: str, k: int = 19, w: int = 5, masked: bool = False, bits: np.ndarray | None = None) -> DataFrame:
    """(name, length, at, code, reverse): the minimisers of each sequence of rows, by place.

    Sequences are cut into overlapping parts, so that a contig spreads over tasks; a place is told by the part that it is in.  bits: a
    filter (bit_filter.code_bits); minimisers whose code it does not hold are left out before they become rows.
    Sequences without k bases in a row have none; a null name is a name.  rows may be a table of chunks (contig, chunk, piece), with contig as name.
    """
    if not 1 <= k <= 31 or w < 1:
        raise ValueError("k must be 1 to 31, w at least 1")
    genome = rows if rows.columns == ["contig", "chunk", "piece"] else rows.select(F.col(name).alias("name"), F.col(seq).alias("seq"))
    parts = overlapping(genome, w - 1, w + k - 2)
    kind = rows.schema[name].dataType
    shared = rows.sparkSession.sparkContext.broadcast(bits) if bits is not None else None
    schema = f"id {kind.simpleString()}, length long, at long, code long, reverse boolean"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, found = [], []
            own = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("start", "own", "until")}
            for row, piece in enumerate(batch.column("piece").to_pylist()):
                code, reverse, order = canonical_codes(digits_of(piece, masked), k)
                at = chosen(order, w)
                place = at + own["start"][row]
                at = at[(place >= own["own"][row]) & (place < own["until"][row])]
                if shared is not None:
                    at = at[passing(shared.value, code[at].view(np.uint64))]
                which.append(np.full(len(at), row))
                found.append((at + own["start"][row], code[at], reverse[at]))
            if which:
                rows_of = pa.array(np.concatenate(which).astype(np.int64))
                columns = [pa.array(np.concatenate([f[i] for f in found])) for i in range(3)]
                ids = [batch.column("contig").take(rows_of).cast(to_arrow_type(kind)), batch.column("length").take(rows_of)]
                yield pa.RecordBatch.from_arrays([*ids, *columns], names=["id", "length", "at", "code", "reverse"])

    return parts.mapInArrow(read, schema).withColumnRenamed("id", name)
