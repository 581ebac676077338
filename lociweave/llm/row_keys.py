"""Rows of a table told apart by an id, which may be null or repeated, and a key of their content."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.storage import written

#: A filter has 16 bits a key and MOST_WORDS words of 64 bits (64 MB) at most, PACKED words a row.
MOST_WORDS, LEAST_WORDS, PACKED = 1 << 23, 1 << 10, 16


def packed_words(words: DataFrame) -> DataFrame:
    """(block, packed): the 64-bit words of words (word, bits), PACKED of them to a row."""
    each = [F.bit_or(F.when(F.col("word") % PACKED == k, F.col("bits")).otherwise(0)) for k in range(PACKED)]
    return words.groupBy(F.expr(f"word div {PACKED}").alias("block")).agg(F.array(*each).alias("packed"))


def without(held: DataFrame, gone: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """The rows of held that equal no row of gone in the pairs of columns, nulls being equal.

    A bit filter of gone, of bounded size, is broadcast: rows of held that it does not know pass straight through, and only
    the others are shuffled and compared.
    """
    n = gone.count()
    if not n:
        return held
    words = min(MOST_WORDS, max(LEAST_WORDS, 1 << (n // 4).bit_length()))
    place = lambda h: (F.pmod(h, F.lit(words)).alias("word"), F.shiftright(h, 40).bitwiseAND(63).cast("int").alias("bit"))
    marked = gone.select(*place(F.xxhash64(*[F.col(b) for _, b in pairs])))
    bits = marked.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    known = F.broadcast(written(packed_words(bits), "filter"))
    tested = held.select("*", *place(F.xxhash64(*[F.col(a) for a, _ in pairs])))
    met = tested.join(known, F.expr(f"word div {PACKED}") == known["block"], "left")
    maybe = F.expr(f"coalesce(getbit(packed[cast(word % {PACKED} AS int)], bit) = 1, false)")
    same = reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs])
    rest = met.where(maybe).select(*held.columns).join(gone, same, "left_anti")
    return met.where(~maybe).select(*held.columns).unionByName(rest)


def rows_but(docs: DataFrame, key: Column, gone: DataFrame, again: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """docs without the rows of `gone`, and one row for each of `again`, with the columns of docs.

    gone, again: distinct (_id, _key).  key: the same key of a row of docs; a null key is in neither.  Of repeated rows the
    one with the smallest hash of all its columns stays.
    """
    gone, again = written(gone, "gone"), written(again, "again")
    held = docs.select(F.struct("*").alias("_row"), F.col(doc_id).cast(gone.schema["_id"].dataType).alias("_doc"), key.alias("_own"))
    pairs = [("_doc", "_id"), ("_own", "_key")]
    stay = without(held, gone, pairs)
    if again.isEmpty():
        return stay.select("_row.*")
    once = without(stay, again, pairs).select("_row")
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_key"))
    first = F.min_by("_row", F.xxhash64("_row")).alias("_row")
    return once.unionByName(stay.join(again, same, "left_semi").groupBy("_doc", "_own").agg(first).select("_row")).select("_row.*")
