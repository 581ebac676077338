"""Chaining of exon hits into gene and transcript copies, and the choice between competing copies.

Small pure kernels over lists of hits (dicts); lociweave.plans.calls runs them on Spark, one group of hits or calls a
row.  A hit has number, exon_id, start, end (target), block_start, block_end, score (its block's score for its gene),
length, exon_score, bases.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
from bisect import bisect_left, bisect_right
from itertools import accumulate

MAX_CHAINS = 10
INSERTION_COST = 50.0
MAX_RUN = 20


def _place(hit: dict, strand: str) -> tuple[int, int]:
    return (hit["start"], hit["end"]) if strand == "+" else (-hit["end"], -hit["start"])


def _block(hit: dict) -> tuple[int, int]:
    return hit["block_start"], hit["block_end"]


def supplier_key(hit: dict) -> tuple:
    """Order in which hits may speak for their block: longest exon, best score, then name and place."""
    return -hit["length"], -hit["exon_score"], hit["exon_id"], hit["start"], hit["end"]


def barriers(hits: list[dict], strand: str) -> dict[int, tuple[float, float]]:
    """For each hit, by position in the list: where the nearest later copy of its exon number ends, and where the
    nearest earlier one starts, along the strand; copies must lie wholly behind or before it.

    One sweep an exon number: the smallest end of all copies that start further on, the largest start of all that end before.
    lociweave.operators.barriers says the same of a table.
    """
    copies: dict[int, list[tuple[int, int]]] = {}
    for hit in hits:
        copies.setdefault(hit["number"], []).append(_place(hit, strand))
    later, earlier = {}, {}
    for number, own in copies.items():
        by_start, by_end = sorted(own), sorted((e, s) for s, e in own)
        least = list(accumulate((e for _, e in reversed(by_start)), min))[::-1]
        most = list(accumulate((s for _, s in by_end), max))
        later[number] = [s for s, _ in by_start], [*least, math.inf]
        earlier[number] = [e for e, _ in by_end], [-math.inf, *most]
    out = {}
    for i, hit in enumerate(hits):
        s, e = _place(hit, strand)
        (starts, least), (ends, most) = later[hit["number"]], earlier[hit["number"]]
        out[i] = least[bisect_left(starts, e)], most[bisect_right(ends, s)]
    return out


class OpenEnds:
    """Chain ends that a later hit may follow: those behind which no further copy of their own exon number lies as yet.

    Ends are kept by exon number; the copies of one number that are open at a time overlap each other, so there are few (one, where
    copies of a number never overlap), and looking for the best end goes through numbers, not through all hits before.
    """

    def __init__(self):
        self.held: dict[int, list[tuple[int, float, int, int, tuple[int, int]]]] = {}  # end, score, hits, place in the order, block

    def add(self, number: int, start: int, end: tuple | None) -> None:
        """A hit that ends here closes the open ends of its number that lie before its start; end: itself, where it is free."""
        still = [x for x in self.held.get(number, ()) if x[0] > start]
        self.held[number] = [*still, end] if end else still

    def best(self, number: int, after: float, block: tuple[int, int], score: float) -> tuple[float, int, int | None]:
        """(score, hits, place) of a hit of that score by itself, or behind the best end of a smaller number that lies behind `after`:
        the highest score, then most hits, then the first.  A block counts once."""
        top: tuple[float, int, int] = (score, 1, -1)
        for n, ends in self.held.items():
            if n >= number:
                continue
            for end, own, count, at, of in ends:
                if end <= after:
                    continue
                made = (own if of == block else own + score, count + 1, at)
                if math.isclose(made[0], top[0]):
                    if (made[1], -made[2]) > (top[1], -top[2]):
                        top = made
                elif made[0] > top[0]:
                    top = made
        return top[0], top[1], None if top[2] < 0 else top[2]


def transcript_chain(hits: list[dict], free: list[int], strand: str, walls: dict[int, tuple[float, float]]) -> list[int]:
    """Best chain among the hits numbered in `free`: rising exon numbers, no overlap, and no other copy of either exon
    wholly within a gap.  A block counts once; ties go to more hits, then to more bases in the last hit.

    A sweep along the strand: hits that have ended are chain ends (OpenEnds) until a further copy of their exon has ended too.
    """
    order = sorted(free, key=lambda i: (*_place(hits[i], strand), hits[i]["number"]))
    best: dict[int, tuple[float, int, int | None]] = {}
    # copies that are no longer free close ends as well
    ends = [(*_place(hits[i], strand)[::-1], -1, i) for i in set(range(len(hits))) - set(free)]
    heapq.heapify(ends)
    opened = OpenEnds()
    for at, h in enumerate(order):
        start, end = _place(hits[h], strand)
        while ends and ends[0][0] <= start:
            e, s, k, i = heapq.heappop(ends)
            opened.add(hits[i]["number"], s, None if k < 0 else (e, best[i][0], best[i][1], k, _block(hits[i])))
        score, count, before = opened.best(hits[h]["number"], walls[h][1], _block(hits[h]), hits[h]["score"])
        best[h] = score, count, None if before is None else order[before]
        heapq.heappush(ends, (end, start, at, h))
    last: int | None = max(order, key=lambda i: (best[i][0], best[i][1], hits[i]["bases"]))
    chain = []
    while last is not None:
        chain.append(last)
        last = best[last][2]
    return chain[::-1]


class BlockEnds:
    """The chain ends of one block by exon number, each with the best of all smaller numbers."""

    def __init__(self, ends: list[tuple]):
        """ends: (number, key, hit), larger keys being better."""
        ends = sorted(ends, key=lambda x: x[0])
        self.numbers = [number for number, *_ in ends]
        self.best = list(accumulate(((key, hit) for _, key, hit in ends), max))

    def below(self, number: int) -> tuple | None:
        """(key, hit) of the best end of a smaller number."""
        k = bisect_left(self.numbers, number)
        return self.best[k - 1] if k else None


class GeneChains:
    """The gene chains of one group, the best first: block scores less INSERTION_COST for every distinct label in a skipped run.

    A block's label is the number of its leading hit.  Runs of more than MAX_RUN labels, gaps of more than max_gap and
    blocks that are no longer free cannot be crossed.  Skipped blocks come back as inserted hits.

    Blocks are gone through in order; a hit looks at the blocks within reach and, in each, at the best end of a smaller number (BlockEnds).
    A chain takes all blocks from its first to its last one, and what lies before them stays as it was, so after a chain only
    the blocks behind it, up to the next that cannot be crossed, are gone through again.
    """

    def __init__(self, hits: list[dict], free: list[int], strand: str, max_gap: int | None):
        self.hits = hits
        blocks = sorted({_block(h) for h in hits}, reverse=strand == "-")
        rank = {b: i for i, b in enumerate(blocks)}
        self.of = [rank[_block(h)] for h in hits]
        leader: dict[int, int] = {}
        speaks: dict[int, tuple] = {}
        for i, hit in enumerate(hits):
            b, key = self.of[i], (supplier_key(hit), hit["number"])
            if b not in leader or key < speaks[b]:
                leader[b], speaks[b] = i, key
        self.leader, self.label = leader, {b: hits[i]["number"] for b, i in leader.items()}
        self.places = [_place(h, strand) for h in hits]
        self.order = sorted(free, key=lambda i: (*self.places[i], hits[i]["number"]))
        self.members: dict[int, list[int]] = {}
        for at, h in enumerate(self.order):
            self.members.setdefault(self.of[h], []).append(at)
        self.best: dict[int, tuple[float, int, int, int | None]] = {}
        self.ended: dict[int, BlockEnds] = {}
        self.segments: list[tuple[tuple, int, int]] = []  # the best end in it, its first and last block
        first = before = None
        for b in sorted(self.members):
            apart = before is None or b != before + 1
            if not apart and max_gap is not None:
                apart = max(blocks[before][0], blocks[b][0]) - min(blocks[before][1], blocks[b][1]) > max_gap
            if apart:
                if before is not None:
                    self._open(first, before, first)
                first = b
            before = b
        if before is not None:
            self._open(first, before, first)

    def _open(self, first: int, last: int, since: int) -> None:
        """A segment of blocks, whose chain ends from block `since` on are to be found."""
        for block in range(since, last + 1):
            self._end(block, first)
        ends = [(*self.best[h][:2], -self.best[h][2], self.hits[h]["bases"], -at) for b in range(first, last + 1) for at in self.members[b] for h in [self.order[at]]]
        self.segments.append((max(ends), first, last))

    def _end(self, block: int, first: int) -> None:
        # (ends, distinct labels between it and this one) of the blocks within reach, nearest first
        reach, labels = [], set()
        for b in range(block - 1, first - 1, -1):
            reach.append((self.ended[b], len(labels)))
            labels.add(self.label[b])
            if len(labels) > MAX_RUN:
                break
        own: list[tuple] = []
        for at in self.members[block]:
            h = self.order[at]
            number, score = self.hits[h]["number"], self.hits[h]["score"]
            pick: dict[int, tuple] = {}
            for ends, cost in reach:
                end = ends.below(number)
                if end and (cost not in pick or end > pick[cost]):
                    pick[cost] = end
            top: tuple[float, int, int, int | None] = (score, 1, 0, None)
            for cost, (_, p) in pick.items():  # nearest first, so by cost
                was = self.best[p]
                made = (was[0] + score - INSERTION_COST * cost, was[1] + 1, was[2] + cost)
                if (made[0], made[1], -made[2]) > (top[0], top[1], -top[2]):
                    top = (*made, p)
            inside = [(key, p) for n, key, p in own if n < number and self.places[p][1] <= self.places[h][0]]
            if inside:
                p = max(inside)[1]
                made = (self.best[p][0], self.best[p][1] + 1, self.best[p][2])
                if (made[0], made[1], -made[2]) > (top[0], top[1], -top[2]):
                    top = (*made, p)
            self.best[h] = top
            own.append((number, (top[0], top[1], -top[2], -at), h))
        self.ended[block] = BlockEnds(own)

    def take(self) -> list[tuple[int, bool]]:
        """The best chain that is left, as (hit, inserted); its blocks are gone."""
        k = max(range(len(self.segments)), key=lambda i: self.segments[i][0])
        (*_, at), first, last = self.segments.pop(k)
        end: int | None = self.order[-at]
        chain = []
        while end is not None:
            chain.append(end)
            end = self.best[end][3]
        chain.reverse()
        out: list[tuple[int, bool]] = []
        for k, i in enumerate(chain):
            if k:
                out += [(self.leader[b], True) for b in range(self.of[chain[k - 1]] + 1, self.of[i])]
            out.append((i, False))
        low, high = self.of[chain[0]], self.of[chain[-1]]
        if low > first:
            self._open(first, low - 1, low)
        if high < last:
            self._open(high + 1, last, high + 1)
        return out


def gene_chain(hits: list[dict], free: list[int], strand: str, max_gap: int | None) -> list[tuple[int, bool]]:
    """The best gene chain as (hit, inserted)."""
    return GeneChains(hits, free, strand, max_gap).take()


def chain_places(hits: list[dict], strand: str, model_type: str, max_gap: int | None, most: int = MAX_CHAINS) -> list[list[tuple[int, bool]]]:
    """Up to `most` chains of one model as (place in hits, inserted); each takes its blocks, inserted ones too, from those that follow."""
    out = []
    if model_type == "full_gene":
        genes = GeneChains(hits, list(range(len(hits))), strand, max_gap)
        while genes.segments and len(out) < most:
            out.append(genes.take())
        return out
    free, walls = list(range(len(hits))), barriers(hits, strand)
    while free and len(out) < most:
        found = [(i, False) for i in transcript_chain(hits, free, strand, walls)]
        out.append(found)
        used = {_block(hits[i]) for i, _ in found}
        free = [i for i in free if _block(hits[i]) not in used]
    return out


def chains_of(hits: list[dict], strand: str, model_type: str, max_gap: int | None, most: int = MAX_CHAINS) -> list[list[dict]]:
    """The chains as hits with `inserted`."""
    return [[{**hits[i], "inserted": inserted} for i, inserted in found] for found in chain_places(hits, strand, model_type, max_gap, most)]


def insertion_runs(hits: list[dict], strand: str) -> list[set[int]]:
    """Distinct exon numbers of every run of inserted hits, along the strand."""
    runs: list[set[int]] = []
    open_ = False
    for hit in sorted(hits, key=lambda h: (*_place(h, strand), h["number"])):
        if hit["inserted"]:
            if not open_:
                runs.append(set())
            runs[-1].add(hit["number"])
        open_ = hit["inserted"]
    return runs


def scored(call: dict, hits: list[dict]) -> dict:
    """The call with these hits: found numbers, raw and weighted score, number of labels of each insertion run."""
    real = [h for h in hits if not h["inserted"]]
    runs = [len(r) for r in insertion_runs(hits, call["strand"])]
    blocks = {_block(h): h["score"] for h in reversed(real)}
    raw = sum(blocks[b] for b in sorted(blocks)) - INSERTION_COST * sum(runs)
    found = sorted({h["number"] for h in real})
    complete = 0 < call["expected"] <= len(found)
    weighted = raw
    for flag, times in ((call["coding"], call["coding_x"]), (complete, call["complete_x"]), (call["mane"], call["mane_x"])):
        weighted *= times if flag else 1.0
    return {**call, "hits": hits, "raw": raw, "weighted": weighted, "found": found, "runs": runs}


def tied_places(calls: list[dict]) -> list[list[int]]:
    """Places of the calls in groups that share blocks, directly or through others."""
    group = list(range(len(calls)))
    seen: dict[tuple[int, int], int] = {}

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for i, call in enumerate(calls):
        for h in call["hits"]:
            j = seen.setdefault(_block(h), i)
            group[root(i)] = root(j)
    out: dict[int, list[int]] = {}
    for i in range(len(calls)):
        out.setdefault(root(i), []).append(i)
    return list(out.values())


def _shape(call: dict) -> list[list]:
    return sorted([h["number"], h["exon_id"], h["start"], h["end"]] for h in call["hits"])


def tie_name(calls: list[dict]) -> str:
    """One name for a set of tied calls, whatever their order."""
    who = sorted([c["gene_id_full"], c["transcript_id_full"], _shape(c)] for c in calls)
    text = json.dumps([calls[0]["query_id"], calls[0]["strand"], who], separators=(",", ":"))
    return "tie_" + hashlib.sha256(text.encode()).hexdigest()[:20]


def resolve(calls: list[dict], prefer_mane: bool, log: list[dict] | None = None) -> list[dict]:
    """Selected calls of one query and strand, each with tie_group_id and tie_count.

    Time and again all calls of the best rank (MANE where preferred, then weighted score) are taken together and their
    blocks are gone for the others, which are scored anew with what they have left.  A call with insertions is scored
    anew as soon as blocks go, because it may rise; others when they come to the top.  Among tied calls that share
    blocks each gene keeps its longest isoform; the others wait for what is left.  log takes (event, call) rows.
    """
    gone: set[tuple[int, int]] = set()
    serial = 0
    heap: list[tuple] = []

    def push(call: dict) -> None:
        nonlocal serial
        heapq.heappush(heap, (-int(prefer_mane and call["mane"]), -call["weighted"], serial, call))
        serial += 1

    def note(event: str, call: dict) -> None:
        if log is not None:
            log.append({"event": event, "call": call})

    def left(call: dict) -> list[dict]:
        return [h for h in call["hits"] if _block(h) not in gone]

    def refresh() -> None:
        nonlocal heap
        kept, again = [], []
        for item in heap:
            call = item[3]
            rest = left(call) if any(h["inserted"] for h in call["hits"]) else call["hits"]
            if len(rest) == len(call["hits"]):
                kept.append(item)
                continue
            note("trim", call)
            if any(not h["inserted"] for h in rest):
                fresh = scored(call, rest)
                if all(n <= MAX_RUN for n in fresh["runs"]):
                    again.append(fresh)
        if again or len(kept) < len(heap):
            heap = kept
            heapq.heapify(heap)
            for call in again:
                push(call)

    def settle() -> None:
        while heap:
            call = heap[0][3]
            rest = left(call)
            if len(rest) == len(call["hits"]):
                return
            heapq.heappop(heap)
            note("trim", call)
            if rest:
                push(scored(call, rest))

    for call in calls:
        if call["hits"]:
            push(call)
    selected = []
    settle()
    while heap:
        mane, score = heap[0][:2]
        batch = []
        while heap and heap[0][0] == mane and math.isclose(heap[0][1], score, rel_tol=1e-12, abs_tol=1e-12):
            batch.append(heapq.heappop(heap)[3])
            settle()
        kept = []
        for places in tied_places(batch):
            by_gene: dict[str, list[dict]] = {}
            for i in places:
                by_gene.setdefault(batch[i]["gene"], []).append(batch[i])
            for own in by_gene.values():
                own.sort(key=lambda c: (-c["exon_length"], c["tid"], _shape(c)))
                kept.append(own[0])
                for loser in own[1:]:
                    note("isoform_tiebreak", loser)
                    push(loser)
        for places in tied_places(kept):
            members = [kept[i] for i in places]
            name = tie_name(members) if len(members) > 1 else ""
            for call in members:
                selected.append({**call, "tie_group_id": name, "tie_count": len(members)})
                note("select", call)
        gone |= {_block(h) for call in kept for h in call["hits"]}
        refresh()
        settle()
    return selected
