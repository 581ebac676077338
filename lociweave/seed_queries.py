"""Queries of the approximate search over the driver's texts, which are read as bases, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.functions.scalars import reverse_complement
from lociweave.operators import minimisers as M
from lociweave.operators.low_complexity import masked_runs
from lociweave.plans.realign import realigned, seed_extensions
from lociweave.plans.seeding import minimiser_seeds, seed_chains
from lociweave.queries import query
from lociweave.storage import read_table, written

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASES = "ACGTACGTACGTACGTACGTACGTACACGTACGTACGTACGTACGTACGTAC"
K, W, MOST = 15, 5, 4

_DNA = f"translate(regexp_replace(text, '[^A-Za-z]', '', 'g'), '{LETTERS}', '{BASES}')"
#: Texts as bases: documents as they are, every other item of the benchmark as its reverse complement.
SEQUENCES = f"""
docs AS (SELECT doc_id, {_DNA} AS s FROM documents WHERE text IS NOT NULL),
items AS (SELECT item_id, CASE WHEN length(text) % 2 = 0 THEN reverse(translate({_DNA}, 'ACGT', 'TGCA')) ELSE {_DNA} END AS s FROM benchmark WHERE text IS NOT NULL)"""


def _bases(df: DataFrame) -> DataFrame:
    dna = F.translate(F.regexp_replace("text", "[^A-Za-z]", ""), LETTERS, BASES)
    return df.where("text IS NOT NULL").withColumn("s", dna)


def sequences(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(items, documents) as bases: item_id or doc_id, and s."""
    items = _bases(read_table(spark, sf_dir, "benchmark"))
    items = items.withColumn("s", F.when(F.length("text") % 2 == 0, reverse_complement(F.col("s"))).otherwise(F.col("s")))
    return items.select("item_id", "s"), _bases(read_table(spark, sf_dir, "documents")).select("doc_id", "s")


def _minimisers(name: str, key: str, table: str) -> str:
    """CTEs that end in `name` (key, at, code, reverse): the smallest order of W stretches in a row, the leftmost of equals."""
    code = f"list_sum([CAST(instr('CGT', substr(v, CAST(j + 1 AS BIGINT), 1)) AS BIGINT) << (2 * ({K} - 1 - j)) FOR j IN range(0, {K})])"
    return f"""
{name}_k AS (
  SELECT {key}, pos, least(v, r) AS mer, r < v AS reverse, v = r AS own
  FROM (SELECT {key}, pos, substr(s, pos + 1, {K}) AS v, reverse(translate(substr(s, pos + 1, {K}), 'ACGT', 'TGCA')) AS r
        FROM (SELECT {key}, s, unnest(range(0, greatest(0, length(s) - {K - 1}))) AS pos FROM {table}))
), {name}_m AS MATERIALIZED (
  SELECT v AS mer, CAST({code} AS BIGINT) AS code FROM (SELECT DISTINCT mer AS v FROM {name}_k)
), {name}_o AS (
  SELECT {key}, pos, code, reverse, own, (xor(code, {M.MIXED}) % {M.PRIME}) * {M.TIMES} % {M.PRIME} AS ord FROM {name}_k JOIN {name}_m USING (mer)
), {name}_w AS (
  SELECT {key}, pos, count(*) OVER whole AS n, count(*) OVER ahead AS seen,
         min(CASE WHEN own THEN NULL ELSE ord * 1000000 + pos END) OVER ahead AS best
  FROM {name}_o WINDOW whole AS (PARTITION BY {key}), ahead AS (PARTITION BY {key} ORDER BY pos ROWS BETWEEN CURRENT ROW AND {W - 1} FOLLOWING)
), {name} AS MATERIALIZED (
  SELECT DISTINCT o.{key}, o.pos, o.code, o.reverse FROM {name}_w w JOIN {name}_o o ON o.{key} = w.{key} AND o.pos = w.best % 1000000
  WHERE w.best IS NOT NULL AND (w.seen = {W} OR (w.n < {W} AND w.pos = 0))
)"""


_FOUND = f"""WITH {SEQUENCES}, {_minimisers("q", "item_id", "items")}, {_minimisers("t", "doc_id", "docs")},
often AS (SELECT code, count(*) AS n FROM t GROUP BY code HAVING count(*) > {MOST})"""


@query(
    f"""{_FOUND} SELECT item_id, doc_id, q.reverse <> t.reverse AS reverse, count(*) AS n_seeds, CAST(sum(q.pos) AS BIGINT) AS query_sum, CAST(sum(t.pos) AS BIGINT) AS target_sum
FROM q JOIN t USING (code) WHERE code NOT IN (SELECT code FROM often) GROUP BY 1, 2, 3"""
)
def minimiser_seeds_found(spark, sf_dir):
    """Minimisers that items and documents share, on either strand."""
    seeds, _ = _seeds(spark, sf_dir)
    sums = F.count("*").alias("n_seeds"), F.sum("query_at").alias("query_sum"), F.sum("target_at").alias("target_sum")
    return seeds.groupBy("item_id", "doc_id", "reverse").agg(*sums)


@query(f"{_FOUND} SELECT code, n FROM often WHERE code IN (SELECT code FROM q)")
def repeated_minimisers(spark, sf_dir):
    """Minimisers of items that are too frequent in documents to seed."""
    return _seeds(spark, sf_dir)[1]


def _seeds(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    items, docs = sequences(spark, sf_dir)
    return minimiser_seeds(items, "item_id", docs, "doc_id", "s", K, W, MOST)


@query()
def seed_chains_found(spark, sf_dir):
    """Where documents may hold an item, by chains of minimisers."""
    return seed_chains(_seeds(spark, sf_dir)[0], "item_id", "doc_id", K)


@query()
def seed_extensions_found(spark, sf_dir):
    """Ungapped extensions of the seeds that chance does not explain."""
    items, docs = sequences(spark, sf_dir)
    found = seed_extensions(_seeds(spark, sf_dir)[0], items, "item_id", docs, "doc_id", "s", K)
    return found.where("evalue <= 1e-6 AND identity >= 90")


@query()
def realigned_windows(spark, sf_dir):
    """Gapped alignments of items in the windows of their chains."""
    items, docs = sequences(spark, sf_dir)
    chains = written(seed_chains(_seeds(spark, sf_dir)[0], "item_id", "doc_id", K), "chains")
    return realigned(chains, items, "item_id", docs, "doc_id", "s", band=32)


_LONG, _HIGH = 64, 1.2


@query(
    f"""WITH {SEQUENCES}, p AS (
  SELECT doc_id, i, i // {_LONG - 2} AS b, substr(s, i + 1, 3) AS v, length(s) AS n FROM (SELECT doc_id, s, unnest(range(0, greatest(0, length(s) - 2))) AS i FROM docs)
), e AS (
  SELECT x.doc_id, greatest(0, y.i - {_LONG - 3}) AS a, least(x.i, x.n - least({_LONG}, x.n)) AS z
  FROM (SELECT *, b + unnest([0, 1]) AS c FROM p) x JOIN p y ON x.doc_id = y.doc_id AND x.v = y.v AND x.c = y.b AND y.i > x.i AND y.i - x.i <= {_LONG - 3}
), d AS (
  SELECT doc_id, pos, sum(v) AS v FROM (SELECT doc_id, a AS pos, 1 AS v FROM e WHERE a <= z UNION ALL SELECT doc_id, z + 1, -1 FROM e WHERE a <= z) GROUP BY 1, 2
), w AS (
  SELECT doc_id, pos, lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS until, sum(v) OVER (PARTITION BY doc_id ORDER BY pos) AS pairs FROM d
), r AS (
  SELECT doc_id, pos AS s0, until - 1 + least({_LONG}, n) AS e0 FROM w JOIN (SELECT doc_id, length(s) AS n FROM docs) USING (doc_id)
  WHERE until IS NOT NULL AND n >= 4 AND pairs > {_HIGH} * (least({_LONG}, n) - 3)
), f AS (
  SELECT *, CASE WHEN s0 <= max(e0) OVER (PARTITION BY doc_id ORDER BY s0, e0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM r
), g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s0, e0) AS k FROM f)
SELECT doc_id, CAST(min(s0) AS BIGINT) AS "start", CAST(max(e0) AS BIGINT) AS "end" FROM g GROUP BY doc_id, k"""
)
def low_complexity(spark, sf_dir):
    """Stretches of documents, read as bases, whose triplets repeat."""
    return masked_runs(sequences(spark, sf_dir)[1], "doc_id", "s", _LONG, _HIGH)
