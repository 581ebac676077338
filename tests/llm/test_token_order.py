"""One order of training sequences, however the table is split."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lociweave.llm import token_shards
from lociweave.storage import written

SEQ = 32


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(3)
    rows = [(k, " ".join(r.choice("river stone under law and the of".split()) for _ in range(r.randint(0, 40)))) for k in range(150)]
    rows += [(None, "no id"), (3, None), (4, ""), (5, "long " * 2000), (1006, "one row of many")] + [(1006, "one row of many")] * 80
    return spark.createDataFrame(rows, "doc_id long, text string")


def plain(rows, key=20240229, end=token_shards.END_OF_TEXT):
    """Sequences by slot, packed one by one from (doc_id, text) in order."""
    encoding = token_shards._encoding(open(token_shards.VOCABULARY, "rb").read())
    ids, owners = [], []
    for i, t in rows:
        own = [*encoding.encode_ordinary(t), end] if t else []
        owners += [(i, len(ids), len(ids) + len(own))] if own else []
        ids += own
    n = -(-len(ids) // SEQ)
    ids += [end] * (n * SEQ - len(ids))
    slots = token_shards.Feistel(n, key).forward(np.arange(n))
    return {int(s): (ids[q * SEQ : (q + 1) * SEQ], [i for i, a, b in owners if a < (q + 1) * SEQ and b > q * SEQ]) for q, s in enumerate(slots)}


def shards(docs, out, **options):
    rows = token_shards.write_shards(docs, out, seq_len=SEQ, per_shard=16, **options).collect()
    read = [x.tolist() for x in token_shards.read_slots(out)]
    listed = {r.slot: r.doc_ids for r in rows}
    assert len(rows) == len(read) == len(listed)
    return {k: (x, listed[k]) for k, x in enumerate(read)}


def by_content(docs, hot=()):
    """The documented order: a hash of id and text; copies of a row that many rows equal have hashes of their own."""
    keyed = docs.where("text != ''").select(F.xxhash64("doc_id", "text").alias("key"), F.xxhash64("text", "doc_id").alias("tie"), "doc_id", "text")
    copy = F.row_number().over(Window.partitionBy("key", "tie").orderBy("key")) - 1
    if hot:
        many = F.col("doc_id").isin(*hot)
        keyed = keyed.withColumn("i", copy.cast("long"))
        keyed = keyed.select(F.when(many, F.xxhash64("key", "i")).otherwise(F.col("key")).alias("key"), F.when(many, F.xxhash64("tie", "i")).otherwise(F.col("tie")).alias("tie"), "doc_id", "text")
    return [(r.doc_id, r.text) for r in keyed.orderBy("key", "tie").collect()]


def test_bytes_do_not_depend_on_partitions(docs, tmp_path):
    want = plain(by_content(docs))
    for n in (1, 3, 7):
        got = shards(docs.repartition(n), (tmp_path / f"of{n}").as_uri())
        assert got == want


def test_a_row_of_many_copies_is_dealt_over_tasks(docs, tmp_path, monkeypatch):
    monkeypatch.setattr(token_shards, "LEAST_HOT", 20)
    want = plain(by_content(docs, hot=[1006]))
    for n in (2, 5):
        assert shards(docs.repartition(n), (tmp_path / f"hot{n}").as_uri()) == want


def test_rows_in_the_order_of_their_files(spark, docs, tmp_path):
    numbered = docs.withColumn("doc_id", F.monotonically_increasing_id()).repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id")
    table = written(numbered, "ordered")
    rows = sorted((r.doc_id, r.text) for r in table.collect())
    assert shards(table, (tmp_path / "files").as_uri(), order="files") == plain(rows)


def test_ids_beyond_16_bits_are_refused(docs, tmp_path):
    with pytest.raises(ValueError, match="16 bits"):
        token_shards.write_shards(docs, (tmp_path / "wide").as_uri(), end=70_000)
