"""Vector code compression: product codes whose codebooks are fitted by Lloyd rounds over heaps.

Rows are packed into chunks of at most CHUNK vectors, once.  A chunk keeps, for each part position and codebook entry, a heap of
the parts assigned to that entry.  A part's key is the slack it had when it was last looked at, lower bound (distance to the
second nearest entry) minus upper bound (distance to its own), plus what its entry had drifted in all until then.  When
entries move, an entry's drift grows by its own move and the largest move of any other, which is what the bounds can lose; so only parts
whose key is at most the drift can have another nearest entry.  A round pops those, compares them with every entry
exactly in integers, and pushes them again; all others are not looked at.  Keys are fixed-point numbers rounded down and drifts are
rounded up, so rounding can cost a look, never a wrong code.

What leaves a chunk in a round are the sums and counts of its entries, which a task adds up before they are shuffled; the driver
sees codebooks alone (positions * entries * width numbers).  Chunks are written to the shared folder after each round, and the
table of the round before goes, so a lost executor repeats its tasks of one round.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.llm.hot_join import join_counted
from lociweave.storage import drop, written

CHUNK = 8192
#: Components become floor(SCALE * x), at most LARGEST either way, so that a squared distance of 1,024 components is a long.
SCALE, LARGEST = 4096, 1 << 25
#: Keys and drifts count in units of 1 / UNIT of a component's unit, in 31 bits.
UNIT, KEY_BITS = 256, 31
MOST_KEY = (1 << KEY_BITS) - 1
STATE = "ids array<long>, labels array<string>, parts binary, codes binary, heaps binary, sizes binary, sums binary, looked long"
RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
FIELDS = ["ids", "labels", "parts", "codes", "heaps", "sizes", "sums", "looked"]
TYPES = [pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.binary()] * 5, pa.int64()]


class Entries:
    """The codebooks of one round and how far each entry can have drifted since the first."""

    def __init__(self, books: np.ndarray, drift: np.ndarray | None = None):
        """books: int64 (positions, entries, width)."""
        self.books = books
        self.drift = np.zeros(books.shape[:2], np.int64) if drift is None else drift

    def moved(self, sums: np.ndarray, counts: np.ndarray) -> Entries:
        """The entries replaced by the floored means of their parts; unused ones stay."""
        new = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], self.books)
        own = np.sqrt(((new - self.books) ** 2).sum(2).astype(np.float64))
        others = np.zeros_like(own)
        for e in range(own.shape[1]):
            rest = np.delete(own, e, 1)
            others[:, e] = rest.max(1) if rest.shape[1] else 0
        step = np.where((own > 0) | (others > 0), np.ceil((own + others) * UNIT) + 2, 0).astype(np.int64)
        return Entries(new, np.minimum(self.drift + step, MOST_KEY))

    def nearest(self, position: int, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, key) of parts (n, width): nearest entry, ties to the lower one, and the heap key by exact distances."""
        best = np.full(len(parts), np.iinfo(np.int64).max)
        second, code = best.copy(), np.zeros(len(parts), np.int64)
        for e, entry in enumerate(self.books[position]):
            far = ((parts - entry) ** 2).sum(1)
            closer = far < best
            second = np.where(closer, best, np.minimum(second, far))
            best, code = np.where(closer, far, best), np.where(closer, e, code)
        slack = (np.sqrt(second.astype(np.float64)) - np.sqrt(best.astype(np.float64))) * UNIT
        key = np.floor(slack).astype(np.int64) - 2 + self.drift[position][code]
        return code, np.clip(key, 0, MOST_KEY)


class Chunk:
    """Parts of some vectors, their codes, and a heap of (key, row) for each position and entry."""

    def __init__(self, ids: list, labels: list, parts: np.ndarray):
        """parts: (positions, n, width) integers."""
        self.ids, self.labels, self.parts = ids, labels, parts
        self.codes = np.zeros(parts.shape[:2], np.uint8)
        self.heaps: list[list[np.ndarray | list]] = []
        self.sums: np.ndarray | None = None
        self.looked = 0

    def assign(self, entries: Entries) -> None:
        """Bring codes, heaps and sums up to date with the entries."""
        positions, n, width = self.parts.shape
        k = entries.books.shape[1]
        fresh = self.sums is None
        if fresh:
            self.sums = np.zeros((positions, k, width + 1), np.int64)
            self.heaps = [[[] for _ in range(k)] for _ in range(positions)]
            popped = [np.arange(n)] * positions
        else:
            popped = [self._violated(p, entries.drift[p]) for p in range(positions)]
        self.looked = 0
        for p, rows in enumerate(popped):
            if not len(rows):
                continue
            self.looked += len(rows)
            mine = self.parts[p][rows].astype(np.int64)
            code, key = entries.nearest(p, mine)
            if not fresh:
                self._add(p, self.codes[p][rows], mine, -1)
            self._add(p, code, mine, 1)
            self.codes[p][rows] = code
            packed = (key << 32 | rows).tolist()
            for e, item in zip(code.tolist(), packed, strict=True):
                self.heaps[p][e].append(item) if fresh else heapq.heappush(self._list(p, e), item)
            if fresh:
                for heap in self.heaps[p]:
                    heapq.heapify(heap)

    def _list(self, p: int, e: int) -> list:
        if not isinstance(self.heaps[p][e], list):
            self.heaps[p][e] = self.heaps[p][e].tolist()
        return self.heaps[p][e]

    def _violated(self, p: int, drift: np.ndarray) -> np.ndarray:
        """Rows popped from the heaps of position p: those whose key is at most their entry's drift."""
        out = []
        for e, most in enumerate(drift.tolist()):
            if len(self.heaps[p][e]) and int(self.heaps[p][e][0]) >> 32 <= most:
                heap = self._list(p, e)
                while heap and heap[0] >> 32 <= most:
                    out.append(heapq.heappop(heap) & 0xFFFFFFFF)
        return np.array(out, np.int64)

    def _add(self, p: int, codes: np.ndarray, parts: np.ndarray, sign: int) -> None:
        np.add.at(self.sums[p], codes, sign * np.concatenate([parts, np.ones((len(parts), 1), np.int64)], 1))

    def row(self) -> tuple:
        flat = [np.asarray(h, np.int64) for heaps in self.heaps for h in heaps]
        sizes = np.array([len(h) for h in flat], np.int32)
        heaps = np.concatenate(flat) if flat else np.zeros(0, np.int64)
        return (self.ids, self.labels, self.parts.tobytes(), self.codes.tobytes(), heaps.tobytes(), sizes.tobytes(), self.sums.tobytes(), self.looked)

    @classmethod
    def read(cls, row: dict, shape: tuple[int, int, int], kind: str) -> Chunk:
        """shape: (positions, entries, width)."""
        positions, k, width = shape
        n = len(row["ids"])
        chunk = cls(row["ids"], row["labels"], np.frombuffer(row["parts"], kind).reshape(positions, n, width))
        chunk.codes = np.frombuffer(row["codes"], np.uint8).reshape(positions, n).copy()
        ends = np.cumsum(np.frombuffer(row["sizes"], np.int32))
        flat = np.split(np.frombuffer(row["heaps"], np.int64), ends[:-1])
        chunk.heaps = [flat[p * k : (p + 1) * k] for p in range(positions)]
        chunk.sums = np.frombuffer(row["sums"], np.int64).reshape(positions, k, width + 1).copy()
        return chunk


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _integers(column: pa.Array, size: int) -> np.ndarray:
    """(n, size) floors of SCALE * x; shorter vectors are filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), size), np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = np.clip(np.floor(values * SCALE), -LARGEST, LARGEST).astype(np.int64)
    return out


def _first_chunks(rows: DataFrame, entries: Entries, kind: str) -> DataFrame:
    positions, _, width = entries.books.shape

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def made() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            whole = _integers(table.column(1).chunk(0), positions * width).reshape(-1, positions, width)
            chunk = Chunk(table.column(0).to_pylist(), table.column(2).to_pylist(), whole.transpose(1, 0, 2).astype(kind))
            chunk.assign(entries)
            return _batch([chunk.row()], FIELDS, TYPES)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                take = min(batch.num_rows - at, CHUNK - sum(b.num_rows for b in held))
                held.append(batch.slice(at, take))
                at += take
                if sum(b.num_rows for b in held) == CHUNK:
                    yield made()
                    held.clear()
        if held:
            yield made()

    return rows.mapInArrow(pack, STATE)


def _next_chunks(state: DataFrame, entries: Entries, kind: str) -> DataFrame:
    shape = entries.books.shape

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                chunk = Chunk.read(batch.slice(k, 1).to_pylist()[0], shape, kind)
                chunk.assign(entries)
                yield _batch([chunk.row()], FIELDS, TYPES)

    return state.mapInArrow(step, STATE)


def _totals(state: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of all chunks; each task adds up its own, so a row a number and task is shuffled."""
    size = shape[0] * shape[1] * (shape[2] + 1)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for sums in batch.column(0).to_pylist():
                total += np.frombuffer(sums, np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["k", "v"])

    out = np.zeros(size, np.int64)
    for row in state.select("sums").mapInArrow(add, "k long, v long").groupBy("k").agg(F.sum("v").alias("v")).collect():
        out[row["k"]] = row["v"]
    out = out.reshape(shape[0], shape[1], shape[2] + 1)
    return out[:, :, :-1], out[:, :, -1]


def _coded(state: DataFrame, entries: Entries, kind: str) -> DataFrame:
    """(vec_id, label, code, error) of the chunks' rows after the last assignment."""
    shape = entries.books.shape

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                chunk = Chunk.read(batch.slice(k, 1).to_pylist()[0], shape, kind)
                chunk.assign(entries)
                error = np.zeros(len(chunk.ids), np.int64)
                for p in range(shape[0]):
                    error += ((chunk.parts[p].astype(np.int64) - entries.books[p][chunk.codes[p]]) ** 2).sum(1)
                codes = [row.tobytes().hex() for row in np.ascontiguousarray(chunk.codes.T)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk.ids, pa.int64()), pa.array(chunk.labels, pa.string()), pa.array(codes, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"]
                )

    return state.mapInArrow(read, "vec_id long, label string, code string, error long")


def _finite(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


class VectorCodes:
    """A fitted product quantiser: `entries`, and the chunks of the rows it was fitted on."""

    def __init__(self, vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"):
        """Fit codebooks on all rows of vectors.

        Rows whose vector is null or holds a null or non-finite component are left out.  Vectors have the length of the longest,
        rounded up to a multiple of `parts`; shorter ones are filled up with zeros, and components beyond 8,192 either way count
        as that.  The codebooks begin with the rows of the smallest ids (a null id comes last, rows of one id by
        their vectors); fewer rows than `entries` make fewer entries.  Repeated rows count each.  An empty table
        has no codebooks.
        """
        named = [F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"), F.col(f"`{label}`").cast("string").alias("label")]
        rows = vectors.select(*named).where(_finite(F.col("vector")))
        widest = F.max(F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector"))))
        found = rows.agg(F.max(F.size("vector")).alias("size"), widest.alias("most"), F.count("*").alias("n")).first()
        self.spark, self.n, self.parts, self.looked = vectors.sparkSession, found["n"], parts, []
        if not self.n:
            return
        width = -(-found["size"] // parts)
        most = min(LARGEST, int(SCALE * min(found["most"] or 0, LARGEST)) + 1)
        self.kind = "int16" if most < 1 << 15 else "int32"
        first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow().combine_chunks()
        start = _integers(first.column(0).chunk(0), parts * width).reshape(-1, parts, width).transpose(1, 0, 2)
        self.entries = Entries(start)
        state = written(_first_chunks(rows.select("vec_id", "vector", "label"), self.entries, self.kind), "codes")
        for k in range(rounds):
            self.looked.append(state.agg(F.sum("looked")).first()[0])
            self.entries = self.entries.moved(*_totals(state, self.entries.books.shape))
            if k < rounds - 1:
                after = written(_next_chunks(state, self.entries, self.kind), "codes")
                drop(state)
                state = after
        self.state = state

    def digest(self) -> str:
        """SHA-256 of the codebooks' numbers by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.books.ravel().tolist())).encode()).hexdigest()

    def rows(self) -> DataFrame:
        """vec_id, label (as text), code (two hex digits a part) and error (squared distance) of every row that was fitted on."""
        return written(_coded(self.state, self.entries, self.kind), "coded")


def encode_vectors(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error (errors summed over equal labels, nulls together) and codebooks_sha256 of each kept row.

    Which rows are kept, and what happens to null, short and repeated ones, VectorCodes says.  No other column is read.
    Sums beyond a long count as the largest long.
    """
    fitted = VectorCodes(vectors, parts, entries, rounds, vec_id, vector, label)
    if not fitted.n:
        return fitted.spark.createDataFrame([], RESULT)
    coded = fitted.rows()
    drop(fitted.state)
    most = F.lit((1 << 63) - 1)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), most.cast("decimal(38,0)")).cast("long")
    sums = written(coded.groupBy("label").agg(total.alias("label_error"), F.count("*").alias("_n")), "labels")
    met = join_counted(coded, sums, ["label"])
    return met.select("vec_id", "code", "error", "label_error", F.lit(fitted.digest()).alias("codebooks_sha256"))
