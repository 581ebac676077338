"""Token-ID / binary output in training order.

Documents are tokenised whole with a public vocabulary, joined in one defined order by an end-of-text id and cut into
sequences of `seq_len` ids, across the tasks that hold them.  A keyed Feistel permutation over the next even power of two, walked on until it lands below the number of
sequences, gives every sequence its own global slot.  Slots are cut into ranges; each range is one file of fixed stride,
so sequence `slot` stands in file slot // per_shard at byte (slot % per_shard) * stride, and a reader that stopped after
any number of sequences goes on from there.

Texts are tokenised once, on their way to the tasks that order them, and written with their place.  One sum a task gives
every text its place among all ids, so that texts are cut into pieces of sequences by themselves; the pieces are dealt by
slot range, in two waves of which each is a shuffle whose partitions are runs of whole shards, so that local disks hold
half of them at a time; a task writes its shards in order.  A shard is written under a draft name and renamed when whole.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.llm.files import Publish, open_file
from lociweave.storage import shared_path, shuffle_width, written

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_OF_TEXT = 50256
SEQ_LEN = 1024
#: Sequences a shard: at most PER_SHARD, and fewer where that would leave less than LEAST_SHARDS shards.
PER_SHARD, LEAST_PER_SHARD, LEAST_SHARDS = 4096, 64, 64
#: Tasks that write; beyond as many shards a task writes several.
MOST_TASKS = 20_000
WAVES = 2
ROWS_AT_ONCE, PIECES_AT_ONCE = 64, 4096
#: Bytes of text for each task that orders, and the least number of equal rows that are dealt over many tasks.
TASK_BYTES, LEAST_HOT = 64 << 20, 10_000
ROUNDS = 6
#: The public pre-tokenisation pattern of this vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encodings: dict[str, tiktoken.Encoding] = {}


def _encoding(raw: bytes) -> tiktoken.Encoding:
    name = hashlib.sha1(raw).hexdigest()
    if name not in _encodings:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
        _encodings[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[name]


class Feistel:
    """A keyed bijection of 0..n-1; forward and back, vectorised."""

    def __init__(self, n: int, key: int):
        self.n, self.half = n, max(1, -(-max(n - 1, 1).bit_length() // 2))
        self.keys = [int.from_bytes(hashlib.blake2b(f"{key}/{i}".encode(), digest_size=8).digest(), "big") | 1 for i in range(ROUNDS)]

    def _mixed(self, x: np.ndarray, key: int) -> np.ndarray:
        h = (x + np.uint64(key & (2**62 - 1))) * np.uint64(key)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(64 - self.half)) if self.half < 64 else h

    def _once(self, x: np.ndarray, keys: list[int], back: bool) -> np.ndarray:
        mask, shift = np.uint64((1 << self.half) - 1), np.uint64(self.half)
        left, right = x >> shift, x & mask
        for key in keys:
            if back:
                left, right = right ^ self._mixed(left, key), left
            else:
                left, right = right, left ^ self._mixed(right, key)
        return left << shift | right

    def _walk(self, x: np.ndarray, keys: list[int], back: bool) -> np.ndarray:
        x = self._once(x.astype(np.uint64), keys, back)
        while len(out := np.flatnonzero(x >= np.uint64(self.n))):
            x[out] = self._once(x[out], keys, back)
        return x.astype(np.int64)

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self.keys, False)

    def back(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self.keys[::-1], True)


def _in_order(docs: DataFrame, doc_id: str, text: str, order: str) -> tuple[DataFrame, int]:
    """(part, key, tie, doc_id, text): rows with a text in an order that does not depend on how the table is split.

    Tasks are ranges of `key`, their number follows from the bytes of all texts.  Returns it too.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *([F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")] if order == "files" else []))
    rows, size, width = rows.where("text != ''"), F.sum(F.octet_length("text")).alias("size"), shuffle_width(docs.sparkSession)
    if order == "files":
        files = rows.groupBy("file").agg(F.max("row").alias("last"), size).collect()
        bases, n = [], 0
        for r in sorted(files, key=lambda r: r["file"]):
            bases.append((r["file"], n))
            n += r["last"] + 1
        tasks = max(width, -(-sum(r["size"] for r in files) // TASK_BYTES))
        base = F.broadcast(docs.sparkSession.createDataFrame(bases, "file string, base long"))  # one row a file
        keyed = rows.join(base, "file").select((F.col("base") + F.col("row")).alias("key"), F.lit(0).cast("long").alias("tie"), "doc_id", "text")
        return keyed.select(F.expr(f"cast(key * {tasks} div {max(n, 1)} AS int)").alias("part"), "*"), tasks
    keyed = rows.select(F.xxhash64("doc_id", "text").alias("key"), F.xxhash64("text", "doc_id").alias("tie"), "doc_id", "text")
    counts = written(keyed.groupBy("key", "tie").agg(F.count("*").alias("n"), size), "keys")
    n, total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = max(width, -(-total // TASK_BYTES))
    many = [tuple(r) for r in counts.where(F.col("n") > max(LEAST_HOT, n // (2 * tasks))).select("key", "tie", "n").collect()]  # at most 2 * tasks rows
    if many:
        # rows that are equal in id and text are alike: one is kept with its count, and its copies get keys of their own
        hot = F.broadcast(docs.sparkSession.createDataFrame(many, "key long, tie long, n long"))
        one = keyed.join(hot, ["key", "tie"]).groupBy("key", "tie", "n").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
        lots = written(one, "hot").withColumn("lot", F.explode(F.expr("sequence(0L, (n - 1) div 256)"))).repartition(tasks)
        each = lots.withColumn("i", F.explode(F.expr("sequence(lot * 256, least(n, lot * 256 + 256) - 1)")))
        copies = each.select(F.xxhash64("key", "i").alias("key"), F.xxhash64("tie", "i").alias("tie"), "doc_id", "text")
        keyed = keyed.join(hot, ["key", "tie"], "left_anti").unionByName(copies)
    place = F.least(F.floor((F.col("key").cast("double") / 2.0**64 + 0.5) * tasks), F.lit(tasks - 1)).cast("int")
    return keyed.select(place.alias("part"), "*"), tasks


def token_table(docs: DataFrame, doc_id: str, text: str, vocabulary: str, end: int, order: str) -> DataFrame:
    """(part, at, n, doc_id, ids): the ids of each text, `end` behind them, as little-endian uint16; n of them begin at `at` of those of part."""
    source, path = open_file(vocabulary)
    with source.open_input_stream(path) as stream:
        raw = docs.sparkSession.sparkContext.broadcast(stream.read())
    if max(end, _encoding(raw.value).max_token_value) > 0xFFFF:
        raise ValueError("ids must fit into 16 bits")
    rows, tasks = _in_order(docs, doc_id, text, order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(raw.value)
        names = ["part", "key", "tie", "doc_id", "n", "ids"]
        for batch in (b.slice(k, ROWS_AT_ONCE) for b in batches for k in range(0, b.num_rows, ROWS_AT_ONCE)):
            ids = [np.array([*encoding.encode_ordinary(t), end], "<u2") for t in batch.column(4).to_pylist()]
            counts = pa.array([len(x) for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], counts, pa.array([x.tobytes() for x in ids], pa.binary())], names=names)

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, int] = {}
        for batch in batches:
            at = []
            for part, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at.append(held.get(part, 0))
                held[part] = at[-1] + n
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.int64()), *batch.columns[1:]], names=["part", "at", "n", "doc_id", "ids"])

    encoded = rows.mapInArrow(encode, "part int, key long, tie long, doc_id long, n long, ids binary")
    dealt = encoded.repartitionById(tasks, F.col("part")).sortWithinPartitions("part", "key", "tie", "doc_id").select("part", "n", "doc_id", "ids")
    return written(dealt.mapInArrow(begin, "part int, at long, n long, doc_id long, ids binary"), "tokens")


def pieces_of(tokens: DataFrame, permutation: Feistel, seq_len: int, slots: tuple[int, int]) -> DataFrame:
    """(slot, at, doc_id, ids): what tokens (start, doc_id, ids) give to the sequences of slots[0] <= slot < slots[1], from id `at` on."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = batch.column(0).to_numpy(zero_copy_only=False)
            doc_ids, ids = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            stop = start + np.array([len(x) // 2 for x in ids], np.int64)
            first = start // seq_len
            counts = (stop - 1) // seq_len - first + 1
            row = np.repeat(np.arange(len(ids)), counts)
            number = first[row] + np.arange(len(row)) - np.repeat(counts.cumsum() - counts, counts)
            slot = permutation.forward(number)
            own = np.flatnonzero((slot >= slots[0]) & (slot < slots[1]))
            for k in range(0, len(own), PIECES_AT_ONCE):
                some = own[k : k + PIECES_AT_ONCE]
                which, begin = row[some], number[some] * seq_len
                low, high = np.maximum(start[which], begin), np.minimum(stop[which], begin + seq_len)
                body = [ids[i][2 * a : 2 * b] for i, a, b in zip(which.tolist(), (low - start[which]).tolist(), (high - start[which]).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot[some]), pa.array(low - begin), pa.array([doc_ids[i] for i in which], pa.int64()), pa.array(body, pa.binary())], names=["slot", "at", "doc_id", "ids"]
                )

    return tokens.select("start", "doc_id", "ids").mapInArrow(cut, "slot long, at long, doc_id long, ids binary")


def write_shards(
    docs: DataFrame, out: str | None = None, key: int = 20240229, doc_id: str = "doc_id", text: str = "text",
    vocabulary: str = VOCABULARY, end: int = END_OF_TEXT, seq_len: int = SEQ_LEN, per_shard: int | None = None, order: str = "content",
) -> DataFrame:
    """Write the shards and their manifest under `out`; returns slot, shard, offset, n_tokens, doc_ids, ids_sha256.

    order: "content" joins texts in the order of a hash of id and text, whatever the table's partitions are; "files" in
    the order of the rows in the files that docs is read from, by path.  Rows equal in id and text are alike, so either
    way the same rows give the same bytes on any cluster.  Only the last sequence of all is filled up.
    doc_ids: documents with ids in the sequence, in order (a document longer than a sequence is in several; a null doc_id
    is listed as null).  Null and empty texts have no ids; repeated rows are tokenised again; an empty table writes the
    manifest alone.  ids_sha256: of the sequence's bytes as they stand in the file.  per_shard: by default a power of two
    that follows from the number of sequences.  vocabulary: a path or address that the driver can read, with ids below 65,536.
    """
    spark = docs.sparkSession
    out = out or shared_path(spark, "tokens")
    table = token_table(docs, doc_id, text, vocabulary, end, order)
    bases, total = [], 0
    for part, count in sorted(map(tuple, table.groupBy("part").agg(F.sum("n")).collect())):
        bases.append((part, total))
        total += count
    n, stride = -(-total // seq_len), 2 * seq_len
    per_shard = per_shard or min(PER_SHARD, max(LEAST_PER_SHARD, 1 << max(0, (n // LEAST_SHARDS).bit_length() - 1)))
    with Publish(f"{out}/manifest.json") as put:
        put.write(json.dumps({"sequences": n, "seq_len": seq_len, "per_shard": per_shard, "dtype": "<u2", "key": key}).encode())
    base = F.broadcast(spark.createDataFrame(bases, "part int, base long"))  # one row a task
    tokens = table.join(base, "part").withColumn("start", F.col("base") + F.col("at"))
    permutation = Feistel(n, key)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces in the order of slot and place; a shard's file is open while its slots come."""
        shard, put, slot, held, owners, done = None, None, None, [], [], []
        names = ["slot", "shard", "offset", "n_tokens", "doc_ids", "ids_sha256"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.string()]

        def finish() -> None:
            nonlocal shard, put
            if slot // per_shard != shard:
                if put:
                    put.__exit__(None)
                shard = slot // per_shard
                put = Publish(f"{out}/shard-{shard:06d}.bin")
                put.__enter__()
            body = b"".join(held)
            count = len(body) // 2
            body += np.full(seq_len - count, end, "<u2").tobytes()
            put.stream.write(body)
            done.append((slot, shard, slot % per_shard * stride, count, owners[:], hashlib.sha256(body).hexdigest()))
            held.clear()
            owners.clear()

        def flush() -> pa.RecordBatch:
            rows = list(zip(*done, strict=True)) or [()] * len(types)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=names)

        for batch in batches:
            for own, number, ids in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)), strict=True):
                if own != slot and held:
                    finish()
                slot = own
                held.append(ids)
                owners.append(number)
            yield flush()
        if held:
            finish()
        if put:
            put.__exit__(None)
        yield flush()

    shards = -(-n // per_shard)
    schema = "slot long, shard int, offset long, n_tokens int, doc_ids array<long>, ids_sha256 string"
    made = None
    for wave in range(WAVES):
        low, high = wave * shards // WAVES, (wave + 1) * shards // WAVES
        if low == high and made is not None:
            continue
        tasks = max(1, min(MOST_TASKS, high - low))
        task = F.expr(f"cast((slot div {per_shard} - {low}) * {tasks} div {max(1, high - low)} AS int)")
        own = pieces_of(tokens, permutation, seq_len, (low * per_shard, high * per_shard)).withColumn("task", task)
        ranged = own.repartitionById(tasks, F.col("task")).sortWithinPartitions("slot", "at").drop("task")
        rows = written(ranged.mapInArrow(write, schema), "shards")
        made = rows if made is None else made.unionByName(rows)
    return made


def read_slots(out: str, first: int = 0, count: int | None = None) -> Iterator[np.ndarray]:
    """Sequences of the slots first, first + 1, ... in order, one shard file open at a time."""
    source, path = open_file(out)
    with source.open_input_stream(f"{path}/manifest.json") as stream:
        facts = json.loads(stream.read())
    stride, slot = 2 * facts["seq_len"], first
    stop = facts["sequences"] if count is None else min(facts["sequences"], first + count)
    while slot < stop:
        shard = slot // facts["per_shard"]
        with source.open_input_file(f"{path}/shard-{shard:06d}.bin") as file:
            until = min(stop, (shard + 1) * facts["per_shard"])
            file.seek(slot % facts["per_shard"] * stride)
            for _ in range(slot, until):
                yield np.frombuffer(file.read(stride), facts["dtype"])
        slot = until
