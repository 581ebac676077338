"""Local alignment with affine gaps inside a band, for all pairs of a batch at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LOW = -(1 << 28)
#: Cells of one block of pairs that are kept for the way back, a byte each.
CELLS = 1 << 26
STOP, DIAGONAL, INSERTED, DELETED = range(4)
_OPS = np.frombuffer(b"=XID", np.uint8)
_PLAIN = np.zeros(256, bool)
_PLAIN[list(b"ACGT")] = True


@dataclass(frozen=True)
class Costs:
    """A match adds, all else takes away; a gap of n bases costs gap_first + (n - 1) * gap_next, gap_first being no less than gap_next."""

    match: int = 1
    mismatch: int = 2
    gap_first: int = 7
    gap_next: int = 2


def _padded(texts: list[bytes], low: np.ndarray, width: int, filler: int) -> np.ndarray:
    """(n, width): text[low : low + width] of each text, filled up where it has no such places."""
    out = np.full((len(texts), width), filler, np.uint8)
    for k, text in enumerate(texts):
        a, b = max(0, int(low[k])), min(len(text), int(low[k]) + width)
        if b > a:
            out[k, a - low[k] : b - low[k]] = np.frombuffer(text, np.uint8)[a:b]
    return out


def _block(queries: list[bytes], targets: list[bytes], diagonal: np.ndarray, band: int, costs: Costs) -> list[tuple]:
    size, width, n = max(map(len, queries), default=0), 2 * band + 1, len(queries)
    q = _padded(queries, np.zeros(n, np.int64), size, 1)
    t = _padded(targets, diagonal - band, size + width, 2)
    plain = _PLAIN[q]
    sources = np.zeros((size, n, width), np.uint8)
    column = np.arange(width) * costs.gap_next
    high, down = np.zeros((n, width), np.int32), np.full((n, width), LOW, np.int32)
    best, row, col = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    side = np.full((n, 1), LOW, np.int32)
    for i in range(size):
        own = t[:, i : i + width]
        score = np.where((own == q[:, i : i + 1]) & plain[:, i : i + 1], costs.match, np.where(own == 2, LOW, -costs.mismatch)).astype(np.int32)
        opened, further = np.hstack([high[:, 1:], side]) - costs.gap_first, np.hstack([down[:, 1:], side]) - costs.gap_next
        down = np.maximum(np.maximum(opened, further), LOW)
        straight = high + score
        inner = np.maximum(np.maximum(straight, down), 0)
        # a gap along the target: the best start of all columns before, less what each column further costs
        ahead = np.maximum.accumulate(inner + column, axis=1)[:, :-1]
        across = np.hstack([side, ahead - column[:-1] - costs.gap_first])
        high = np.maximum(inner, across)
        source = np.where(high == 0, STOP, np.where(high == straight, DIAGONAL, np.where(high == down, INSERTED, DELETED)))
        longer = np.hstack([np.zeros((n, 1), bool), across[:, :-1] - costs.gap_next > inner[:, :-1] - costs.gap_first])
        sources[i] = source | (further > opened) << 2 | longer << 3
        top = high.argmax(1)
        value = high[np.arange(n), top]
        better = value > best
        best, row, col = np.where(better, value, best), np.where(better, i, row), np.where(better, top, col)
    return _traced(q, t, sources, best, row, col, diagonal - band)


def _traced(q: np.ndarray, t: np.ndarray, sources: np.ndarray, best: np.ndarray, row: np.ndarray, col: np.ndarray, shift: np.ndarray) -> list[tuple]:
    """The ways back from the best cells, a step of all pairs at a time."""
    n = len(best)
    ends = row + 1, row + col + shift + 1
    i, c, mode = row.copy(), col.copy(), np.full(n, STOP)  # mode: in a gap of that kind, or in none
    live = np.flatnonzero(best > 0)
    steps: list[np.ndarray] = []
    while len(live):
        at, own = sources[i[live], live, c[live]], mode[live]
        kind = np.where(own == STOP, at & 3, own)
        # cells of value zero, and the row before the first, are where a way begins
        done = kind == STOP
        live, at, kind = live[~done], at[~done], kind[~done]
        op = np.full(n, 255, np.uint8)
        straight, up = live[kind == DIAGONAL], kind == INSERTED
        op[straight] = np.where(q[straight, i[straight]] == t[straight, i[straight] + c[straight]], 0, 1)
        op[straight] = np.where(_PLAIN[q[straight, i[straight]]], op[straight], 1)
        op[live[up]], op[live[kind == DELETED]] = 2, 3
        mode[straight] = STOP
        mode[live[up]] = np.where(at[up] & 4, INSERTED, STOP)
        over = kind == DELETED
        mode[live[over]] = np.where(at[over] & 8, DELETED, STOP)
        i[live[~over]] -= 1
        c[live[up]] += 1
        c[live[over]] -= 1
        steps.append(op)
        live = live[i[live] >= 0]
    ways = np.array(steps, np.uint8).reshape(len(steps), n)[::-1]
    out = []
    for k in range(n):
        way = ways[:, k][ways[:, k] < 255]
        counts = np.bincount(way, minlength=4)
        edge = np.flatnonzero(np.r_[True, way[1:] != way[:-1]]) if len(way) else np.zeros(0, np.int64)
        runs = zip(np.diff(np.append(edge, len(way))), way[edge], strict=True)
        q_end, t_end = (int(ends[0][k]), int(ends[1][k])) if len(way) else (0, 0)
        q_start, t_start = q_end - int(counts[:3].sum()), t_end - int(counts[0] + counts[1] + counts[3])
        out.append((int(best[k]), q_start, q_end, t_start, t_end, *map(int, counts), "".join(f"{m}{chr(_OPS[op])}" for m, op in runs)))
    return out


def banded_alignments(queries: list[bytes], targets: list[bytes], diagonals: list[int], band: int, costs: Costs = Costs()) -> list[tuple]:
    """(score, query start, query end, target start, target end, matches, mismatches, inserted, deleted, CIGAR) of the best local alignment of each pair.

    Only cells (i, j) of query and target with |j - i - diagonal| <= band count.  Bases are compared as they are; only A, C, G and T match.  Of
    equal scores the one that ends first in the query, then in the target, is taken; without a match all are 0 and the CIGAR is empty.
    Pairs are aligned in blocks of like length, so that what is kept for the way back stays within CELLS bytes or one pair.
    """
    order = sorted(range(len(queries)), key=lambda k: len(queries[k]))
    out: list[tuple] = [()] * len(queries)
    first = 0
    while first < len(order):
        last = first + 1
        while last < len(order) and (last + 1 - first) * max(1, len(queries[order[last]])) * (2 * band + 1) <= CELLS:
            last += 1
        own = order[first:last]
        made = _block([queries[k] for k in own], [targets[k] for k in own], np.array([diagonals[k] for k in own], np.int64), band, costs)
        for k, found in zip(own, made, strict=True):
            out[k] = found
        first = last
    return out
