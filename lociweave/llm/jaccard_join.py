"""N-gram Jaccard join: documents whose shingle sets have a Jaccard similarity of at least percent / 100, by prefix trees.

Sets, all of them, in one global order.  A first pass over the texts makes every document's set and counts how many
sets fall into each of a fixed number of hash slots; the order of shingles is (slot count class, hash), rare first.
Documents of equal sets are one from here on.

Where to look.  Two sets that are similar enough share a shingle among the first n - ceil(percent * n / 100) + 1 of
either, so only sets that share such a prefix shingle need meet.  They meet at the shingle's pivot, the smallest set that
has it: the sets of one pivot, over all its shingles, make a cell.  Near copies of one text have few pivots between
them, and a cell whose sets all meet in one other cell is left out; so the work grows with the sets and not with the
pairs.  Within a cell, the shared prefix shingles of two sets plus what can follow the earlier of their prefixes bound
their overlap, and only sets that this leaves a partner are read whole.

How to look.  The sets of a cell, as sequences in the global order, make a prefix tree whose equal beginnings are walked
once for all sets that share them: every node adds its overlap with the probe to its parent's, and a subtree goes when
even all that remains of the probe and of its longest set could not reach the bound.  A set that is already in the
probe's component needs no second link, so a cell gives at most one link a set.  Cells of more than CELL sets are cut
into blocks that meet a few hub sets first, and then only blocks' sets outside the main component are walked through
the other blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.llm.kernels import give_back, shingle_sets
from lociweave.llm.row_keys import rows_but
from lociweave.operators.graph import connected_components
from lociweave.storage import shuffle_width, written

CELL = 2048
HUBS = 32
SLOT_BLOCK = 4096
SLOTS_PER_ROW, LEAST_SLOTS, MOST_SLOTS = 16, 1 << 16, 1 << 24
MOST_WORDS = 1 << 21


# ---------------------------------------------------------------- sets and their order


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def document_sets(docs: DataFrame, doc_id: str, text: str, words: int, slots: int, key: Column | None = None) -> DataFrame:
    """One pass: rows (doc_id, n, set_id, key) of documents, and rows (block, counts) of slot counts of a task."""
    key = F.lit(None).cast("binary") if key is None else key
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), key.alias("key"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "set_id", "block", "counts", "key"]
        count = np.zeros(slots, np.uint32)
        for batch in batches:
            n, ids = [], []
            for s in shingle_sets(batch.column(1), words):
                n.append(len(s))
                ids.append(_digest(s))
                count[(s & np.uint64(slots - 1)).astype(np.int64)] += 1
            nothing = [None] * len(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(nothing, pa.int32()), pa.array(nothing, pa.binary()),
                 batch.column(2)], names=names
            )
        used = [b for b in range(-(-slots // SLOT_BLOCK)) if count[b * SLOT_BLOCK : (b + 1) * SLOT_BLOCK].any()]
        nothing = [None] * len(used)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nothing, pa.int64()), pa.array(nothing, pa.int64()), pa.array(nothing, pa.binary()), pa.array(used, pa.int32()),
             pa.array([count[b * SLOT_BLOCK : (b + 1) * SLOT_BLOCK].tobytes() for b in used], pa.binary()), pa.array(nothing, pa.binary())], names=names
        )

    return written(rows.mapInArrow(read, "doc_id long, n long, set_id binary, block int, counts binary, key binary"), "sets")


def slot_classes(counts: DataFrame, slots: int) -> np.ndarray:
    """Class of each slot, 8 to a doubling of its count, one byte a slot: at most MOST_SLOTS bytes reach the driver."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(raw, np.uint32).astype(np.uint64)
                held[block] = held[block] + own if block in held else own
        classes = [np.minimum(255, np.round(8 * np.log2(c + 1.0))).astype(np.uint8).tobytes() for c in held.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(classes, pa.binary())], names=["block", "classes"])

    out = np.zeros(-(-slots // SLOT_BLOCK) * SLOT_BLOCK, np.uint8)
    dealt = counts.repartition(min(shuffle_width(counts.sparkSession), max(1, slots // SLOT_BLOCK)), "block")
    for row in dealt.mapInArrow(total, "block int, classes binary").toLocalIterator():
        own = np.frombuffer(row["classes"], np.uint8)
        out[row["block"] * SLOT_BLOCK : row["block"] * SLOT_BLOCK + len(own)] = own
    return out


def ordered(s: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """A sorted set in the global order: by class of its slot, then by hash."""
    return s[np.argsort(classes[(s & np.uint64(len(classes) - 1)).astype(np.int64)], kind="stable")]


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


# ---------------------------------------------------------------- prefix tree of one cell


class PrefixTree:
    """Radix tree over sequences of ranks, laid out by depth so that one probe's step down is a few array operations."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        #: For each level: parent's place in the level above, first and last set below, tokens, where they begin.
        self.levels: list[dict[str, np.ndarray]] = []
        nodes = [(0, 0, len(sets), 0)]
        while nodes:
            parents, lows, highs, tokens, lengths, depths, below = [], [], [], [], [], [], []
            for at, low, high, depth in nodes:
                while low < high:
                    if self.sizes[low] == depth:
                        stop, end = low + 1, depth
                    else:
                        token = sets[low][depth]
                        stop = low + 1
                        while stop < high and self.sizes[stop] > depth and sets[stop][depth] == token:
                            stop += 1
                        end = self._common(low, stop - 1, depth)
                    parents.append(at)
                    lows.append(low)
                    highs.append(stop)
                    tokens.append(sets[low][depth:end])
                    lengths.append(end - depth)
                    depths.append(end)
                    if stop - low > 1 or self.sizes[low] > end:
                        below.append((len(parents) - 1, low, stop, end))
                    low = stop
            lows, highs = np.array(lows), np.array(highs)
            self.levels.append(
                {
                    "parent": np.array(parents), "low": lows, "high": highs, "depth": np.array(depths), "length": np.array(lengths),
                    "tokens": np.concatenate(tokens) if tokens else np.zeros(0, np.int64), "begin": np.cumsum([0, *lengths])[:-1],
                    "least": np.array([self.sizes[a:b].min() for a, b in zip(lows, highs, strict=True)]),
                    "most": np.array([self.sizes[a:b].max() for a, b in zip(lows, highs, strict=True)]),
                    "last": np.array([t[-1] if len(t) else -1 for t in tokens]),
                }
            )
            nodes = below

    def _common(self, a: int, b: int, depth: int) -> int:
        """Length of the beginning that sets a..b (in lexicographic order) share."""
        x, y = self.sets[a], self.sets[b]
        n = min(len(x), len(y))
        differ = np.flatnonzero(x[depth:n] != y[depth:n])
        return depth + int(differ[0]) if len(differ) else n

    def links(self, probe: int, inside: np.ndarray, component: np.ndarray, later: bool) -> list[int]:
        """Sets of other components that are similar enough; inside marks the probe's tokens; later: sets behind it."""
        since = probe + 1 if later else 0
        x, n = self.sets[probe], int(self.sizes[probe])
        found: list[int] = []
        overlap = np.zeros(1, np.int64)
        alive = np.ones(1, bool)
        for level in self.levels:
            go = np.flatnonzero(alive[level["parent"]] & (level["high"] > since))
            new = np.zeros(len(level["parent"]), np.int64)
            ok = np.zeros(len(level["parent"]), bool)
            if len(go):
                # lengths alone
                go = go[(100 * level["most"][go] >= self.percent * n) & (100 * n >= self.percent * level["least"][go])]
            if len(go):
                lengths = level["length"][go]
                ends = np.cumsum(lengths)
                take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(level["begin"][go] - (ends - lengths), lengths)
                sums = np.r_[0, np.cumsum(inside[level["tokens"][take]])]
                new[go] = overlap[level["parent"][go]] + sums[ends] - sums[ends - lengths]
                rest = n - np.searchsorted(x, level["last"][go], "right")
                rest = np.where(lengths > 0, rest, n)
                bound = new[go] + np.minimum(rest, level["most"][go] - level["depth"][go])
                # percent * (n + m - overlap) <= 100 * overlap for the smallest m below
                go = go[(100 + self.percent) * bound >= self.percent * (n + level["least"][go])]
                ok[go] = True
                for k in go:
                    low, high = int(level["low"][k]), int(level["high"][k])
                    if high - low == 1 and self.sizes[low] == level["depth"][k]:
                        if (
                            low >= since
                            and component[low] != component[probe]
                            and (100 + self.percent) * new[k] >= self.percent * (n + self.sizes[low])
                        ):
                            found.append(low)
                        ok[k] = False
                    elif (component[max(low, since) : high] == component[probe]).all():
                        ok[k] = False
            overlap, alive = new, ok
            if not alive.any():
                break
        return found


def spanning_links(sets: list[np.ndarray], classes: np.ndarray, percent: int, probes: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs of places in `sets` that join all sets linked in this cell, at most one fewer than sets.

    sets: distinct hashes in any order.  probes: marks of sets of which each pair must hold one (all by default).
    """
    if len(sets) < 2:
        return []
    tokens, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    by_order = np.empty(len(tokens), np.int64)
    by_order[np.lexsort((tokens, classes[(tokens & np.uint64(len(classes) - 1)).astype(np.int64)]))] = np.arange(len(tokens))
    ends = np.cumsum([len(s) for s in sets])
    ranked = [np.sort(by_order[inverse[e - len(s) : e]]) for s, e in zip(sets, ends, strict=True)]
    order = sorted(range(len(sets)), key=lambda i: ranked[i].astype(">i8").tobytes())
    tree = PrefixTree([ranked[i] for i in order], percent)
    component = np.arange(len(sets))
    inside = np.zeros(len(tokens), bool)
    out = []
    for at, place in enumerate(order):
        if probes is not None and not probes[place]:
            continue
        inside[ranked[place]] = True
        for hit in tree.links(at, inside, component, probes is None):
            if component[hit] != component[at]:
                out.append((place, order[hit]))
                component[component == component[hit]] = component[at]
        inside[ranked[place]] = False
    return out


# ---------------------------------------------------------------- cells


def _words_of(hashes: DataFrame, words: int) -> DataFrame:
    """(word, bits): a bit for each hash, 64 to a word; at most `words` rows of 16 bytes."""
    bit = F.shiftright("h", 40).bitwiseAND(63).cast("int")
    marked = hashes.select(F.pmod("h", F.lit(words)).alias("word"), bit.alias("bit")).distinct()
    return marked.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))


def _maybe(rows: DataFrame, h, hashes: DataFrame, n: int) -> DataFrame:
    """The rows whose hash h may be among the n hashes: a filter of at most MOST_WORDS words, broadcast."""
    words = min(MOST_WORDS, 1 << max(6, int(2 * n).bit_length()))
    held = F.broadcast(_words_of(hashes, words))
    marked = rows.withColumn("_h", h).withColumn("_word", F.pmod("_h", F.lit(words)))
    met = marked.join(held, marked["_word"] == held["word"])
    return met.where("getbit(bits, cast(shiftright(_h, 40) & 63 AS int)) = 1").select(rows.columns)


def prefix_postings(docs: DataFrame, text: str, words: int, percent: int, order) -> DataFrame:
    """(token, set_id, n, last) for the prefix shingles that two different sets may have; last: the prefix's last."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, tokens = [], [], []
            for s in shingle_sets(batch.column(0), words):
                if len(s):
                    ids.append(_digest(s))
                    sizes.append(len(s))
                    tokens.append(ordered(s, order.value)[: prefix_length(len(s), percent)].view(np.int64))
            lengths = np.cumsum([0, *map(len, tokens)]).astype(np.int32)
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat))],
                names=["set_id", "n", "tokens"],
            )

    rows = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(read, "set_id binary, n long, tokens array<long>")
    prefixes = written(rows.dropDuplicates(["set_id"]), "prefixes")
    each = prefixes.select(F.explode("tokens").alias("token"), "set_id", "n", F.element_at("tokens", -1).alias("last"))
    twice = written(each.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select(F.col("token").alias("h")), "twice")
    return written(_maybe(each, F.col("token"), twice, twice.count()), "postings")


def cells_of(postings: DataFrame) -> DataFrame:
    """(cell, set_id, n, last, tokens, size): sets that must meet, each cell named by its pivot; tokens: shared ones."""
    pivots = written(postings.groupBy("token").agg(F.min("set_id").alias("cell"), F.count("*").alias("c")).where("c > 1").drop("c"), "pivots")
    shared = written(postings.join(pivots, "token"), "shared")
    members = written(shared.select("cell", "set_id").distinct(), "members")
    first = members.groupBy("set_id").agg(F.min("cell").alias("first"))
    led = members.join(first, "set_id")
    kept = led.groupBy("cell").agg(F.min("first").alias("a"), F.max("first").alias("b"), F.count("*").alias("size"))
    kept = written(kept.where("size > 1 AND NOT (a = b AND a <> cell)").select("cell", "size"), "cells")
    stored = shared.groupBy("set_id").agg(F.first("n").alias("n"), F.first("last").alias("last"), F.collect_list("token").alias("tokens"))
    return written(members.join(kept, "cell").join(stored, "set_id"), "cells")


def candidate_groups(tokens: list[np.ndarray], sizes: np.ndarray, lasts: np.ndarray, classes: np.ndarray, percent: int) -> list[list[int]]:
    """Places of the sets of one cell, in groups that candidate pairs join; sets without a candidate are left out.

    tokens: the prefix shingles of each set that other sets have too.  What two sets share lies in both prefixes or
    behind the end of the prefix that ends first, where that set has `rest` shingles.
    """
    lasts = lasts.view(np.uint64)
    end = np.empty(len(sizes), np.int64)
    order = np.lexsort((lasts, classes[(lasts & np.uint64(len(classes) - 1)).astype(np.int64)]))
    end[order] = np.cumsum(np.r_[True, lasts[order][1:] != lasts[order][:-1]])
    rest = sizes - np.array([prefix_length(int(n), percent) for n in sizes])
    _, codes = np.unique(np.concatenate(tokens), return_inverse=True)
    owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    by_code = np.argsort(codes, kind="stable")
    begins = np.searchsorted(codes[by_code], np.arange(codes.max() + 2))
    holders = owner[by_code]
    ends = np.cumsum([len(t) for t in tokens])
    group = np.arange(len(tokens))
    for x in range(len(tokens)):
        own = codes[ends[x] - len(tokens[x]) : ends[x]]
        overlap = np.bincount(np.concatenate([holders[begins[c] : begins[c + 1]] for c in own]), minlength=len(tokens))
        bound = overlap + np.where(end[x] <= end, rest[x], rest)
        fits = (overlap > 0) & ((100 + percent) * bound >= percent * (sizes[x] + sizes)) & (group != group[x])
        fits &= (100 * sizes >= percent * sizes[x]) & (100 * sizes[x] >= percent * sizes)
        joined = np.unique(group[np.flatnonzero(fits)])
        if len(joined):
            group[np.isin(group, joined)] = group[x]
    return [np.flatnonzero(group == g).tolist() for g, n in zip(*np.unique(group, return_counts=True), strict=True) if n > 1]


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Column lists of each run of rows that are equal in the first column."""
    held: dict[str, list] = {}
    for batch in batches:
        names = batch.schema.names
        columns = [c.to_pylist() if not pa.types.is_list(c.type) else c for c in batch.columns]
        for k, name in enumerate(columns[0]):
            if held and held[names[0]][0] != name:
                yield held
                held = {}
            for n, c in zip(names, columns, strict=True):
                held.setdefault(n, []).append(c[k].values.to_numpy() if isinstance(c, pa.Array) else c[k])
        give_back()
    if held:
        yield held
    give_back()


def refined(cells: DataFrame, order, percent: int) -> DataFrame:
    """(group, set_id): the candidate groups of the cells, each once, named by the sets in them."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _by_group(batches):
            ids = cell["set_id"]
            groups = candidate_groups(cell["tokens"], np.array(cell["n"]), np.array(cell["last"]), order.value, percent)
            names, members = [], []
            for own in groups:
                name = hashlib.blake2b(b"".join(sorted(ids[i] for i in own)), digest_size=16).hexdigest()
                names += [name] * len(own)
                members += [ids[i] for i in own]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(members, pa.binary())], names=["group", "set_id"])

    rows = cells.select("cell", "set_id", "n", "last", "tokens")
    dealt = rows.repartition(shuffle_width(cells.sparkSession), "cell").sortWithinPartitions("cell")
    return written(dealt.mapInArrow(split, "group string, set_id binary").distinct(), "groups")


def _cell_links(groups: DataFrame, sets: DataFrame, order, percent: int) -> DataFrame:
    """(a, b): spanning links of every group (group, set_id, probe); probe null: all pairs of the group count."""
    met = groups.join(sets, "set_id").select("group", "set_id", "probe", "tokens")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _by_group(batches):
            sets = {}
            for set_id, probe, tokens in zip(cell["set_id"], cell["probe"], cell["tokens"], strict=True):
                sets[set_id] = (probe or sets.get(set_id, (None,))[0], tokens.view(np.uint64).copy())
            ids = list(sets)
            probes = None if cell["probe"][0] is None else np.array([bool(sets[i][0]) for i in ids])
            pairs = spanning_links([sets[i][1] for i in ids], order.value, percent, probes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[x] for x, _ in pairs], pa.binary()), pa.array([ids[y] for _, y in pairs], pa.binary())], names=["a", "b"]
            )

    dealt = met.repartition(shuffle_width(groups.sparkSession), "group").sortWithinPartitions("group")
    return dealt.mapInArrow(linked, "a binary, b binary")


def similar_sets(docs: DataFrame, own: DataFrame, doc_id: str, text: str, words: int, percent: int, classes: np.ndarray, cell: int = CELL) -> DataFrame:
    """(node, component) of the sets that have a link.  own: (set_id, d, c), a document of each set."""
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(classes)
    members = cells_of(prefix_postings(docs, text, words, percent, order))
    groups = refined(members.where(F.col("size") <= cell), order, percent)
    large = members.where(F.col("size") > cell).select("cell", "set_id", "size")
    wanted = groups.select("set_id").unionByName(large.select("set_id")).distinct()
    ids = written(own.join(wanted, "set_id").select(F.xxhash64("d").alias("h")), "readers")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(0), words))
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(s) for s in sets], pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["set_id", "tokens"]
            )

    chosen = _maybe(docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("text")), F.xxhash64("d"), ids, ids.count())
    sets = written(chosen.select("text").mapInArrow(read, "set_id binary, tokens array<long>"), "whole")
    blocks = F.ceil(F.col("size") / cell)
    code, other = F.xxhash64("set_id"), F.xxhash64(F.lit(1), F.col("set_id"))
    own = F.pmod(code, blocks)
    hub = F.pmod(other, F.col("size")) < HUBS
    places = F.when(hub, F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(F.array(own))
    group = lambda *c: F.concat_ws("/", F.hex("cell"), *[x.cast("string") for x in c])
    dealt = large.select("cell", "set_id", F.explode(places).alias("block")).select(group(F.col("block")).alias("group"), "set_id")
    dealt = groups.unionByName(dealt).withColumn("probe", F.lit(None).cast("boolean"))
    links = written(_cell_links(dealt, sets, order, percent), "links")
    if not large.isEmpty():
        # sets outside the main component of a large cell are walked through all its blocks
        found = connected_components(links, "a", "b")
        named = large.join(found, large["set_id"] == found["node"], "left").withColumn("component", F.coalesce("component", "set_id"))
        named = written(named.select("cell", "set_id", "size", "component"), "large")
        sizes = named.groupBy("cell", "component").agg(F.count("*").alias("c"))
        main = sizes.groupBy("cell").agg(F.max(F.struct("c", "component")).alias("m"), F.sum("c").alias("all"))
        main = main.select("cell", F.col("m.component").alias("main"), (F.col("all") - F.col("m.c")).alias("others")).where("others > 0")
        split = written(named.join(main, "cell"), "strays")
        chunks = F.ceil(F.col("others") / cell)
        stray = split.where("component <> main")
        probes = stray.select("cell", "set_id", F.pmod(other, chunks).alias("chunk"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), F.lit(True).alias("probe"))
        walked = split.select("cell", "set_id", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"), own.alias("block"), F.lit(False).alias("probe"))
        again = probes.unionByName(walked).select(group(F.col("chunk"), F.col("block")).alias("group"), "set_id", "probe")
        links = written(links.unionByName(_cell_links(again, sets, order, percent)), "links")
    return connected_components(links, "a", "b")


def labelled(
    docs: DataFrame, doc_id: str, text: str, words: int, percent: int, cell: int = CELL, key: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n, set_id, key) of docs, and (_set, component_id, group) of the sets that are in a group of rows.

    group names a component, whatever the ids in it.
    """
    rows = docs.count()
    slots = min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (SLOTS_PER_ROW * rows).bit_length()))
    both = document_sets(docs, doc_id, text, words, slots, key)
    classes = slot_classes(both.where("block IS NOT NULL").select("block", "counts"), slots)
    table = both.where("set_id IS NOT NULL").select("doc_id", "n", "set_id", "key")
    own = table.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("d"), F.count("*").alias("c"))
    own = written(own, "own")
    components = written(similar_sets(docs, own, doc_id, text, words, percent, classes, cell), "components")
    named = own.join(components, own["set_id"] == components["node"], "left").select("set_id", "d", "c", "component")
    named = written(named.where("c > 1 OR component IS NOT NULL"), "named")
    roots = named.where("component IS NOT NULL").groupBy("component").agg(F.min("d").alias("root"))
    label = named.join(roots, "component", "left")
    label = label.select(F.col("set_id").alias("_set"), F.coalesce("root", "d").alias("component_id"), F.coalesce("component", "set_id").alias("group"))
    return table, written(label, "label")


def near_duplicate_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, cell: int = CELL
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) for every row of docs.

    Words are runs of non-white-space characters, A-Z lower-cased; a set holds the distinct shingles of `words` words, the
    whole sequence for a text of fewer words, nothing for a null text or one without words.  Two rows link when
    100 * intersection >= percent * union; empty sets link with nothing.  Repeated rows are rows of one set; a null doc_id
    counts as no id (a component of such rows alone has a null component_id).  An empty table gives no rows.
    """
    table, label = labelled(docs, doc_id, text, words, percent, cell)
    met = table.join(label, table["set_id"] == label["_set"], "left")
    alone = F.when(F.col("_set").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return met.select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of docs of each component, with all its columns; rows without words all stay.

    Rows are told apart by doc_id and text, so rows of one id may have different fates.  The row of the smallest doc_id
    stays (a null doc_id last), of several rows of that id the one whose text has the smallest SHA-256.  Of rows that
    repeat both id and text one stays, whichever has the smaller hash of all its columns.
    """
    key = F.unhex(F.sha2(F.col("text").cast("string").cast("binary"), 256))
    table, label = labelled(docs, "doc_id", "text", words, percent, key=key)
    members = table.join(label, table["set_id"] == label["_set"]).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "group")
    members = members.groupBy("group", "_id", "_key").agg(F.count("*").alias("c"))
    members = written(members, "members")
    lead = members.groupBy("group").agg(F.min(F.struct(F.col("_id").isNull().alias("unnamed"), "_id", "_key")).alias("lead"))
    judged = members.join(lead, "group").withColumn("leads", F.col("_id").eqNullSafe(F.col("lead._id")) & (F.col("_key") == F.col("lead._key")))
    return rows_but(docs, key, judged.where("NOT leads").select("_id", "_key"), judged.where("leads AND c > 1").select("_id", "_key"))
