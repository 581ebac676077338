"""Interval views of the driver's tables, on which every operator can be run at any scale."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.storage import dealt, file_bytes, input_width, read_table

#: Parts of more bytes are joined by a sort on both sides, which is then dealt by the size of the input.
LARGE = 10 << 20

#: The same view in SQL.
HITS = """
hits AS (
  SELECT CAST(l_suppkey AS BIGINT) AS query_id, CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '+' END AS strand,
         CAST(date_diff('day', TIMESTAMP '1992-01-01', l_shipdate) * 10 AS BIGINT) AS qs,
         CAST(date_diff('day', TIMESTAMP '1992-01-01', l_shipdate) * 10 + CAST(l_quantity AS INTEGER) AS BIGINT) AS qe,
         CAST(l_quantity AS BIGINT) AS exon_len,
         CAST(greatest(0, CAST(l_quantity AS INTEGER) - CAST(round(l_tax * 100) AS INTEGER)) AS BIGINT) AS ident,
         l_partkey AS exon_id, CAST(p_size AS BIGINT) AS exon_number, p_brand AS gene, p_brand || ':' || p_type AS tid,
         p_partkey % 5 = 0 AS mane, l_orderkey AS ok, CAST(l_linenumber AS BIGINT) AS ln
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


def hits(spark: SparkSession, sf_dir: str, placed: bool = False) -> DataFrame:
    """Exon hits: suppliers as query sequences, parts as exons, brands as genes, ship dates as positions.

    placed adds (file, row), the place of a hit in the files: (ok, ln) is not unique.
    """
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand", "p_type")
    item = read_table(spark, sf_dir, "lineitem")
    place = ["file", "row"] if placed else []
    if placed:
        item = item.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    if file_bytes(part) > LARGE:
        width = input_width(item)
        item, part = dealt(item, width, ["l_partkey"]), dealt(part, width, ["p_partkey"])
    start = (F.datediff("l_shipdate", F.lit("1992-01-01").cast("date")) * 10).cast("long")
    length = F.col("l_quantity").cast("long")
    return item.join(part, item["l_partkey"] == part["p_partkey"]).select(
        F.col("l_suppkey").cast("long").alias("query_id"),
        F.when(F.col("l_linenumber") % 2 == 0, "-").otherwise("+").alias("strand"),
        start.alias("qs"), (start + length).alias("qe"), length.alias("exon_len"),
        F.greatest(F.lit(0), length - F.round(F.col("l_tax") * 100).cast("long")).alias("ident"),
        F.col("l_partkey").alias("exon_id"), F.col("p_size").cast("long").alias("exon_number"), F.col("p_brand").alias("gene"),
        F.concat_ws(":", "p_brand", "p_type").alias("tid"), (F.col("p_partkey") % 5 == 0).alias("mane"),
        F.col("l_orderkey").alias("ok"), F.col("l_linenumber").cast("long").alias("ln"), *place,
    )


#: Order spans of customers within a priority, for pairwise overlap.
SPANS = """
spans AS (
  SELECT o_orderpriority AS loc, CAST(o_custkey % 300 AS BIGINT) AS gene,
         CAST(date_diff('day', TIMESTAMP '1992-01-01', o_orderdate) AS BIGINT) AS s,
         CAST(date_diff('day', TIMESTAMP '1992-01-01', o_orderdate) + 3 + o_custkey % 5 AS BIGINT) AS e
  FROM orders
)"""


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.datediff("o_orderdate", F.lit("1992-01-01").cast("date")).cast("long")
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("loc"), (F.col("o_custkey") % 300).cast("long").alias("gene"), day.alias("s"),
        (day + 3 + F.col("o_custkey") % 5).alias("e"),
    )
