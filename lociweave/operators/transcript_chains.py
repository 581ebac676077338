"""Transcript chains of many groups at a time: what chains.transcript_chain finds one by one, on arrays of groups of equally many hits."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Hits of a group that are compared pair by pair; larger groups are swept one at a time.
MOST_WIDE = 16
#: math.isclose as it is by default.
CLOSE = 1e-9


@dataclass
class Chains:
    """One entry a chain: its group (a row of the arrays), the places of its hits in the group one chain after another, how many each has, its raw score."""

    group: np.ndarray
    places: np.ndarray
    sizes: np.ndarray
    raw: np.ndarray


def _summed(values: np.ndarray) -> np.ndarray:
    """Sums along rows, compensated as Python's sum() is, so that scores are equal to the last bit."""
    high, low = np.zeros(len(values)), np.zeros(len(values))
    for x in values.T:
        total = high + x
        low += np.where(np.abs(high) >= np.abs(x), (high - total) + x, (x - total) + high)
        high = total
    return high + low


def transcript_chains(number, start, end, block_start, block_end, score, bases, most: int) -> Chains:
    """Up to `most` chains of each group; arguments are (groups, hits) arrays, start and end along the strand and start < end.

    Each chain takes its blocks from those that follow.  Chains of a group come in their order; its hits along the strand.
    """
    order = np.lexsort((number, end, start), axis=-1)
    sort = lambda x: np.take_along_axis(x, order, 1)
    number, start, end, block_start, block_end, score, bases = map(sort, (number, start, end, block_start, block_end, score, bases))
    groups, width = number.shape
    pair = lambda x: (x[:, :, None], x[:, None, :])  # noqa: E731  (first, second) hit
    (n, m), (s, t), (e, f) = pair(number), pair(start), pair(end)
    copy = n == m
    later = np.where(copy & (t >= e), f, np.iinfo(np.int64).max).min(2)
    earlier = np.where(copy & (e <= t), s, np.iinfo(np.int64).min).max(1)
    link = (n < m) & (e <= t) & (later[:, :, None] > t) & (earlier[:, None, :] < e)
    (a, b), (c, d) = pair(block_start), pair(block_end)
    same = (a == b) & (c == d)
    by_block = np.lexsort((block_end, block_start), axis=-1)
    live, free = np.arange(groups), np.ones((groups, width), bool)
    found: list[tuple[np.ndarray, ...]] = []
    for _ in range(most):
        held = free[live].any(1)
        live = live[held]
        if not len(live):
            break
        open_, near, linked, own, weight = free[live], same[live], link[live], score[live], bases[live]
        best, count, before = own.astype(float), np.ones((len(live), width), np.int64), np.full((len(live), width), -1)
        for i in range(width):
            for j in range(i):
                may = linked[:, j, i] & open_[:, j]
                if not may.any():
                    continue
                made, hits, top = np.where(near[:, j, i], best[:, j], best[:, j] + own[:, i]), count[:, j] + 1, best[:, i]
                equal = (made == top) | (np.abs(made - top) <= CLOSE * np.maximum(np.abs(made), np.abs(top)))
                better = may & np.where(equal, hits > count[:, i], made > top)
                best[better, i], count[better, i], before[better, i] = made[better], hits[better], j
        last = open_
        for key in (best, count, weight):
            shown = np.where(last, key, -np.inf)
            last = last & (shown == shown.max(1)[:, None])
        at = last.argmax(1)
        taken, rows = np.zeros((len(live), width), bool), np.arange(len(live))
        while len(rows):
            taken[rows, at] = True
            at = before[rows, at]
            rows, at = rows[at >= 0], at[at >= 0]
        # a block counts once, with its first hit; blocks are summed in their order
        again = (taken[:, :, None] & near & np.triu(np.ones((width, width), bool), 1)).any(1)
        raw = _summed(np.take_along_axis(np.where(taken & ~again, own, 0.0), by_block[live], 1))
        who, place = np.nonzero(taken)
        found.append((live, order[live[who], place], taken.sum(1), raw))
        free[live] &= ~(taken[:, :, None] & near).any(1)
    return Chains(*[np.concatenate(x) for x in zip(*found, strict=True)])
