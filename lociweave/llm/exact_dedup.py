"""Exact dedup: two-pass Bloom filtering, DataFrame functions only.

Pass 1 hashes every normalised text to two bits of one 64-bit filter word and finds the bits that two rows or more set.
The hashes are written in lots, bucketed by lot, so that each lot is folded into two planes of the filter, bits set at
least once and bits set at least twice, without an exchange; only planes are exchanged, a block of BLOCK_WORDS words of a
lot as one row of 16-bit places, and merged.  Bits set twice make the filter of possibly repeated hashes.  Pass 2 tests every row: a row with a bit of its own
is certainly the only one and passes straight through; only the others are shuffled by their hash and compared exactly.

The filter has ROWS_PER_WORD rows a word and at most FILTER_WORDS words of 8 bytes, packed into arrays, so what is
broadcast never exceeds 100 MB.  More rows than fit are filtered in several rounds, each over a range of hashes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.llm.row_keys import PACKED, packed_words, rows_but
from lociweave.storage import shared_path, shuffle_width, written

FILTER_WORDS = 1 << 23
ROWS_PER_WORD = 4
#: Words of a block, whose 65,536 bits have places of 16 bits.
BLOCK_WORDS = 1024
WHITE_SPACE = "[\\x20\\x09-\\x0D]"


def written_in_lots(rows: DataFrame) -> DataFrame:
    """rows with a column `lot`, written as Parquet bucketed by it; a lot holds what one task in `width` tasks wrote."""
    spark, width = rows.sparkSession, shuffle_width(rows.sparkSession)
    # one number for each bucket, so that lots and buckets are the same
    found = spark.range(32 * width).select(F.col("id").cast("int").alias("lot")).groupBy(F.pmod(F.hash("lot"), F.lit(width))).agg(F.min("lot").alias("lot"))
    lots = F.array(*[F.lit(x) for x in sorted(r["lot"] for r in found.collect())])
    name, path = f"lots_{uuid.uuid4().hex}", shared_path(spark, "lots")
    dealt = rows.withColumn("lot", F.get(lots, F.pmod(F.spark_partition_id(), F.size(lots))))
    dealt.write.bucketBy(width, "lot").option("path", path).format("parquet").saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the files stay, and the frame knows them


def lot_planes(keys: DataFrame) -> DataFrame:
    """(block, once, twice): the bits of a block of the filter that a lot of keys (lot, word, bit_a, bit_b) sets, and those set by two rows or more.

    Bits are 16-bit places in the block, so a row of the table costs its lot four bytes at most, and a bit that many rows
    set two or four in all.  There is a row for each lot and block at most, however many rows the lot has.
    """
    at = lambda bit: (F.col("word") % BLOCK_WORDS * 64 + F.col(bit)).cast("int")
    bits = keys.select("lot", F.expr(f"word div {BLOCK_WORDS}").alias("block"), F.explode(F.array_distinct(F.array(at("bit_a"), at("bit_b")))).alias("bit"))
    counted = bits.groupBy("lot", "block", "bit").agg(F.count("*").alias("n"))
    place = (F.col("bit") - 32768).cast("short")
    return counted.groupBy("lot", "block").agg(F.collect_list(place).alias("once"), F.collect_list(F.when(F.col("n") > 1, place)).alias("twice")).drop("lot")


def repeated_filter(keys: DataFrame) -> DataFrame:
    """(block, packed): PACKED words of the bits that at least two rows of keys (lot, word, bit_a, bit_b) set."""
    # a bit set twice in a lot is in both lists, one set in two lots in two lists; all of a block are then in one task
    met = lot_planes(keys).repartition("block")
    bits = met.select("block", F.explode(F.concat("once", "twice")).alias("place")).groupBy("block", "place").agg(F.count("*").alias("n")).where("n > 1")
    bits = bits.select("block", (F.col("place").cast("int") + 32768).alias("bit"))
    each = bits.groupBy("block", F.expr("bit div 64").alias("part")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 AS int)))").alias("bits"))
    return packed_words(each.select((F.col("block") * BLOCK_WORDS + F.col("part")).alias("word"), "bits"))


def _judged(docs: DataFrame, doc_id: str, text: str, filter_words: int) -> DataFrame:
    """exact_dedup with the column points."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    narrow = written_in_lots(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.char_length(body).alias("points"),
            F.sha2(F.regexp_replace(body, WHITE_SPACE, "").cast("binary"), 256).alias("text_sha256"),
        )
    )
    rows = narrow.count()
    rounds = max(1, -(-rows // (ROWS_PER_WORD * filter_words)))
    words = min(filter_words, 1 << max(4, (rows // ROWS_PER_WORD).bit_length()))
    code = F.xxhash64("text_sha256")
    keyed = narrow.select(
        "*",
        F.pmod(F.shiftright(code, 44), F.lit(rounds)).alias("range"),
        F.pmod(code, F.lit(words)).alias("word"),
        F.shiftright(code, 32).bitwiseAND(63).cast("int").alias("bit_a"),
        F.shiftright(code, 38).bitwiseAND(63).cast("int").alias("bit_b"),
    )
    tested = None
    for k in range(rounds):
        part = keyed.where(F.col("range") == k)
        seen = F.broadcast(written(repeated_filter(part), "filter"))
        bits = F.expr(f"packed[cast(word % {PACKED} AS int)]")
        met = part.join(seen, F.expr(f"word div {PACKED}") == seen["block"], "left").withColumn("bits", bits)
        met = met.select("doc_id", "points", "text_sha256", F.expr("coalesce(getbit(bits, bit_a) = 1 AND getbit(bits, bit_b) = 1, false)").alias("again"))
        if rounds > 1:
            met = written(met, "tested")  # frees the round's filter
        tested = met if tested is None else tested.unionByName(met)
    alone = tested.where("NOT again").select(
        "doc_id", "points", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    again = tested.where("again").select("doc_id", "points", "text_sha256")
    first = F.struct((-F.col("points")).alias("less"), F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"))
    # written, so that the join below has two plain exchanges and Spark can split the rows of a hot hash
    groups = written(again.groupBy(F.col("text_sha256").alias("key")).agg(F.min(first).alias("best"), F.count("*").alias("group_size")), "groups")
    met = again.join(groups, again["text_sha256"] == groups["key"]).select(
        "doc_id",
        "points",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("points") == -F.col("best.less"))).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(met)


def exact_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", filter_words: int = FILTER_WORDS
) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without the characters of WHITE_SPACE; null counts as empty.  The row with the most
    code points stays, then the smallest doc_id (a null doc_id last).  Rows that repeat both the doc_id and the text are
    one document: they count in group_size and share the decision.  An empty table gives no rows; other columns are
    ignored, whatever their names.
    """
    return _judged(docs, doc_id, text, filter_words).drop("points")


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs of each group of equal texts, with all its columns.

    Every row is judged by its own text, whatever its id: rows of one id or of a null id may have different fates.  Of
    rows that repeat the id of the row that stays, with as many code points, one stays.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = lambda sha, points: F.concat_ws("/", sha, points)
    own = key(F.sha2(F.regexp_replace(body, WHITE_SPACE, "").cast("binary"), 256), F.char_length(body).cast("string"))
    judged = _judged(docs, doc_id, text, FILTER_WORDS).where("group_size > 1")
    judged = judged.select(F.col("doc_id").alias("_id"), key(F.col("text_sha256"), F.col("points").cast("string")).alias("_key"), "kept")
    judged = judged.groupBy("_id", "_key", "kept").agg(F.count("*").alias("c"))
    judged = written(judged, "judged")
    return rows_but(docs, own, judged.where("NOT kept").select("_id", "_key"), judged.where("kept AND c > 1").select("_id", "_key"), doc_id)
