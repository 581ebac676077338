"""Low-complexity stretches of sequences: windows in which few triplets of bases are many times repeated."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lociweave.operators.intervals import bins_for, merged
from lociweave.operators.minimisers import digits_of
from lociweave.operators.stretches import overlapping
from lociweave.storage import written

#: Bases of a contig whose masked runs are merged by one task.
BIN = 1_000_000
#: Bases that are read together.
TOGETHER = 1 << 16


def equal_triplets(digits: np.ndarray, window: int) -> np.ndarray:
    """For each window of so many bases, the pairs of places in it with one triplet; triplets with other letters equal none.

    By lags: pairs of places d apart are counted for all windows at once, from running sums.
    """
    triplet = digits[:-2] * np.uint8(25) + digits[1:-1] * np.uint8(5) + digits[2:]
    known = (digits[:-2] < 4) & (digits[1:-1] < 4) & (digits[2:] < 4)
    whole = bool(known.all())
    n = window - 2
    pairs = np.zeros(max(0, len(triplet) - n + 1), np.int32)
    for d in range(1, n):
        same = triplet[d:] == triplet[:-d]
        total = np.zeros(len(same) + 1, np.int32)
        np.cumsum(same if whole else same & known[d:], dtype=np.int32, out=total[1:])
        pairs += total[n - d :][: len(pairs)]
        pairs -= total[: len(pairs)]
    return pairs


def masked_runs(rows: DataFrame, name: str, seq: str, window: int = 64, threshold: float = 2.0) -> DataFrame:
    """(name, start, end): stretches of each sequence of rows that low-complexity windows cover, merged where they touch.

    A window's score is the sum over its triplets of c * (c - 1) / 2, c being how often a triplet is in it, over the number of its triplets less
    one; a window with a score above `threshold` is masked.  Case does not matter.  A sequence shorter than a window is one window;
    with fewer than four bases it is none.  Names must be unique; rows without a name are left out.
    """
    if window < 4:
        raise ValueError("a window has four bases at least")
    parts = overlapping(rows.where(F.col(name).isNotNull()).select(F.col(name).alias("name"), F.col(seq).alias("seq")), 0, window - 1)
    kind = rows.schema[name].dataType

    def scored(pieces: list[str], size: int) -> np.ndarray:
        """Pairs of all windows of the pieces, one after another; those that begin in one piece and end in the next mean nothing."""
        return equal_triplets(np.concatenate([digits_of(p, False) for p in pieces]), size)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, starts, ends = [], [], []
            at, until = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("start", "until"))
            pieces = batch.column("piece").to_pylist()
            sizes = [window if at[row] or len(piece) >= window else len(piece) for row, piece in enumerate(pieces)]
            # pieces of one size of window are read together, so many bases at a time
            runs, last = [], None
            for row in sorted((row for row, piece in enumerate(pieces) if sizes[row] >= 4 and len(piece) >= sizes[row]), key=sizes.__getitem__):
                if last is None or last[0] != sizes[row] or last[1] > TOGETHER:
                    last = [sizes[row], 0, []]
                    runs.append(last)
                last[1] += len(pieces[row])
                last[2].append(row)
            for size, _, rows_ in runs:
                pairs, begin = scored([pieces[row] for row in rows_], size), 0
                for row in rows_:
                    own = pairs[begin : begin + len(pieces[row]) - size + 1][: until[row] - at[row]]
                    begin += len(pieces[row])
                    high = np.concatenate([[0], (own > threshold * (size - 3)).astype(np.int8), [0]])
                    edge = np.flatnonzero(np.diff(high))
                    which.append(np.full(len(edge) // 2, row))
                    starts.append(edge[::2] + at[row])
                    ends.append(edge[1::2] + at[row] + size - 1)
            if which:
                ids = batch.column("contig").take(pa.array(np.concatenate(which).astype(np.int64))).cast(to_arrow_type(kind))
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(np.concatenate(x).astype(np.int64)) for x in (starts, ends)]], names=["id", "start", "end"])

    runs = written(parts.mapInArrow(read, f"id {kind.simpleString()}, start long, end long"), "runs")
    bin_size = bins_for(runs, ["id"], BIN)
    return merged(runs, ["id"], "start", "end", touching=True, bin_size=bin_size).select(F.col("id").alias(name), "start", "end")


def soft_masked(rows: DataFrame, name: str, seq: str, runs: DataFrame) -> DataFrame:
    """rows with the runs (name, start, end; disjoint) of their sequence in lower case, all else in upper case; names unique."""
    listed = runs.groupBy(F.col(name).alias("_of")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_runs"))
    met = rows.join(listed, F.col(name) == F.col("_of"), "left")
    body = F.upper(seq)
    cut = lambda low, high: body.substr((low + 1).cast("int"), (high - low).cast("int"))
    done = F.aggregate(
        "_runs",
        F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).cast("long").alias("at")),
        lambda a, r: F.struct(F.concat(a["parts"], F.array(cut(a["at"], r["start"]), F.lower(cut(r["start"], r["end"])))).alias("parts"), r["end"].alias("at")),
        lambda a: F.concat(F.array_join(a["parts"], ""), cut(a["at"], F.length(seq).cast("long"))),
    )
    return met.select(*[F.coalesce(done, body).alias(c) if c == seq else F.col(c) for c in rows.columns])
