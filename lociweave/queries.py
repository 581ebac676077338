"""Queries of the interval engine over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.operators.barriers import may_follow, with_barriers
from lociweave.operators.graph import connected_components
from lociweave.operators.intervals import equal_copy_counts, islands, merged, overlap_length, range_join
from lociweave.plans.derived import HITS, SPANS, hits, spans
from lociweave.plans.evidence import block_scores, expected_exons, hits_of, non_overlapping, with_block_scores, with_blocks
from lociweave.storage import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
KEYS = ["query_id", "strand"]


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL of the same result."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _all() -> None:
    import lociweave.library_queries  # noqa: F401  registers its own
    import lociweave.seed_queries  # noqa: F401
    import lociweave.table_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _all()
    return dict(SQL)


# ---------------------------------------------------------------- islands and scores

_ISLANDS = f"""
WITH {HITS}, f AS (
  SELECT *, CASE WHEN qs {{op}} max(qe) OVER (PARTITION BY query_id, strand ORDER BY qs, qe, ok, ln
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM hits
), n AS (
  SELECT *, sum(fresh) OVER (PARTITION BY query_id, strand ORDER BY qs, qe, ok, ln) AS block_id FROM f
)"""
_BLOCKS = _ISLANDS.format(op="<")
_MERGED = " SELECT query_id, strand, CAST(block_id AS BIGINT) AS block_id, min(qs) AS block_start, max(qe) AS block_end, count(*) AS n_hits FROM n GROUP BY query_id, strand, block_id"
_SCORE = "(CASE WHEN exon_len <= 0 THEN 0.0 ELSE 100.0 * (exon_len - 4.0 * (exon_len - least(greatest(ident, 0), exon_len))) / exon_len END)"


def _merged(spark: SparkSession, sf_dir: str, touching: bool, bin_size: int | None = None) -> DataFrame:
    numbered = islands(hits(spark, sf_dir), KEYS, "qs", "qe", touching, "block_id", bin_size)
    return numbered.groupBy(*KEYS, "block_id").agg(F.min("qs").alias("block_start"), F.max("qe").alias("block_end"), F.count("*").alias("n_hits"))


@query(_BLOCKS + _MERGED)
def merged_blocks(spark, sf_dir):
    return _merged(spark, sf_dir, False)


@query(_ISLANDS.format(op="<=") + _MERGED)
def merged_blocks_touching(spark, sf_dir):
    return _merged(spark, sf_dir, True)


@query(_BLOCKS + _MERGED)
def merged_blocks_binned(spark, sf_dir):
    return _merged(spark, sf_dir, False, bin_size=2000)


@query(f"WITH {HITS} SELECT ok, ln, exon_id, round({_SCORE}, 6) AS score FROM hits")
def exon_score(spark, sf_dir):
    score = S.exon_score(F.col("exon_len"), F.col("ident"))
    return hits(spark, sf_dir).select("ok", "ln", "exon_id", F.round(score, 6).alias("score"))


@query(
    _BLOCKS + f""", r AS (
  SELECT *, {_SCORE} AS score,
         row_number() OVER (PARTITION BY query_id, strand, block_id, gene ORDER BY exon_len DESC, {_SCORE} DESC, exon_id, qs, qe, ok, ln) AS k FROM n
) SELECT query_id, strand, CAST(block_id AS BIGINT) AS block_id, gene, round(score, 6) AS score, exon_len AS supplier_length, exon_id AS supplier_exon_id FROM r WHERE k = 1"""
)
def block_gene_scores(spark, sf_dir):
    found = with_blocks(hits(spark, sf_dir), "qs", "qe")
    best = block_scores(found, "gene", "exon_len", "ident", ["exon_id", "qs", "qe", "ok", "ln"])
    return best.select(*KEYS, "block_id", "gene", F.round("score", 6).alias("score"), "supplier_length", "supplier_exon_id")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every target block and gene: the score, and the exon that supplies it."""
    return block_gene_scores(spark, sf_dir)


# ---------------------------------------------------------------- filters and joins


@query(f"WITH {HITS} SELECT ok, ln, exon_id FROM hits WHERE exon_id IN (SELECT p_partkey FROM part WHERE p_size <= 10)")
def eligible_semi(spark, sf_dir):
    eligible = read_table(spark, sf_dir, "part").where("p_size <= 10").select(F.col("p_partkey").alias("exon_id"))
    return hits(spark, sf_dir).join(eligible, "exon_id", "left_semi").select("ok", "ln", "exon_id")


@query(f"WITH {HITS} SELECT ok, ln, gene FROM hits WHERE gene NOT IN (SELECT p_brand FROM part WHERE p_size = 50 AND p_brand IS NOT NULL)")
def paralog_anti(spark, sf_dir):
    dropped = read_table(spark, sf_dir, "part").where("p_size = 50").select(F.col("p_brand").alias("gene")).distinct()
    return hits(spark, sf_dir).join(dropped, "gene", "left_anti").select("ok", "ln", "gene")


@query(
    f"""WITH {HITS}, r AS (SELECT CASE WHEN NOT (exon_len > 5) THEN 'AS' WHEN NOT ({_SCORE} > 80) THEN 'identity'
  WHEN NOT (qs < 20000 AND qe > 5000) THEN 'region' ELSE 'kept' END AS outcome FROM hits)
SELECT outcome, count(*) AS n FROM r GROUP BY outcome"""
)
def known_exon_region_filter(spark, sf_dir):
    score = S.exon_score(F.col("exon_len"), F.col("ident"))
    outcome = F.when(~(F.col("exon_len") > 5), "AS").when(~(score > 80), "identity").when(~((F.col("qs") < 20000) & (F.col("qe") > 5000)), "region").otherwise("kept")
    return hits(spark, sf_dir).groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def _assoc(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("exon_id"), F.concat_ws(":", "p_brand", "p_type").alias("tid"), F.col("p_size").cast("long").alias("exon_number"))


@query(
    """SELECT p_brand || ':' || p_type AS tid, string_agg(DISTINCT CAST(p_size AS VARCHAR), ',' ORDER BY CAST(p_size AS VARCHAR)) AS numbers
FROM part WHERE p_partkey % 3 <> 0 GROUP BY 1"""
)
def expected_exons_of(spark, sf_dir):
    eligible = read_table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("exon_id"))
    text = F.array_join(F.array_sort(F.transform("numbers", lambda x: x.cast("string"))), ",")
    return expected_exons(_assoc(spark, sf_dir), eligible).select("tid", text.alias("numbers"))


@query(
    f"""WITH {HITS}, a AS (SELECT p_type AS tid, p_partkey AS exon_id, CAST(p_size AS BIGINT) AS exon_number FROM part
  UNION ALL SELECT p_brand, p_partkey, CAST(p_size AS BIGINT) FROM part)
SELECT ok, ln, a.tid, a.exon_number FROM hits JOIN a ON a.exon_id = hits.exon_id"""
)
def hit_fanout(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    one = lambda c: part.select(F.col(c).alias("tid"), F.col("p_partkey").alias("exon_id"), F.col("p_size").cast("long").alias("exon_number"))
    assoc = one("p_type").unionByName(one("p_brand"))
    rows = hits(spark, sf_dir).select("ok", "ln", "exon_id")
    return hits_of(rows, assoc, expected_exons(assoc)).select("ok", "ln", "tid", "exon_number")


_PAIRS = f"""WITH RECURSIVE {SPANS}, m AS (
  SELECT loc, gene, s, e, CASE WHEN s <= max(e) OVER (PARTITION BY loc, gene ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
  FROM spans
), g AS (SELECT loc, gene, s, e, sum(fresh) OVER (PARTITION BY loc, gene ORDER BY s, e) AS k FROM m),
u AS (SELECT loc, gene, min(s) AS s, max(e) AS e FROM g GROUP BY loc, gene, k),
pairs AS (
  SELECT a.loc, a.gene AS gene_a, b.gene AS gene_b, CAST(sum(least(a.e, b.e) - greatest(a.s, b.s)) AS BIGINT) AS shared
  FROM u a JOIN u b ON a.loc = b.loc AND a.gene < b.gene AND a.s < b.e AND b.s < a.e GROUP BY 1, 2, 3
)"""


def _shared_pairs(spark, sf_dir):
    union = merged(spans(spark, sf_dir), ["loc", "gene"], "s", "e", touching=True)
    a = union.select("loc", F.col("gene").alias("gene_a"), F.col("s").alias("s_a"), F.col("e").alias("e_a"))
    b = union.select("loc", F.col("gene").alias("gene_b"), F.col("s").alias("s_b"), F.col("e").alias("e_b"))
    met = range_join(a, b, ["loc"], 32, ("s_a", "e_a"), ("s_b", "e_b")).where("gene_a < gene_b")
    shared = F.sum(overlap_length(F.col("s_a"), F.col("e_a"), F.col("s_b"), F.col("e_b"))).alias("shared")
    return met.groupBy("loc", "gene_a", "gene_b").agg(shared)


@query(_PAIRS + " SELECT * FROM pairs WHERE shared > 10")
def shared_span_pairs(spark, sf_dir):
    return _shared_pairs(spark, sf_dir).where("shared > 10")


@query(
    _PAIRS + """, edges AS (SELECT gene_a AS a, gene_b AS b FROM pairs WHERE shared > 14 UNION SELECT gene_b, gene_a FROM pairs WHERE shared > 14),
reach AS (SELECT a AS node, a AS seen FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.seen)
SELECT node, min(seen) AS component FROM reach GROUP BY node"""
)
def gene_components(spark, sf_dir):
    return connected_components(_shared_pairs(spark, sf_dir).where("shared > 14"), "gene_a", "gene_b")


@query(
    _BLOCKS.replace("PARTITION BY query_id, strand", "PARTITION BY gene, strand") + """, b AS (
  SELECT gene, strand, block_id, min(qs) AS s, max(qe) AS e FROM n GROUP BY gene, strand, block_id
) SELECT gene, strand, s, e, row_number() OVER (PARTITION BY gene, strand ORDER BY CASE WHEN strand = '+' THEN s ELSE -s END) AS block_number FROM b"""
)
def full_model_blocks(spark, sf_dir):
    union = merged(hits(spark, sf_dir), ["gene", "strand"], "qs", "qe", touching=False)
    last = union.groupBy("gene", "strand").agg(F.max("island").alias("n"))
    number = F.when(F.col("strand") == "+", F.col("island")).otherwise(F.col("n") + 1 - F.col("island"))
    return union.join(last, ["gene", "strand"]).select("gene", "strand", F.col("qs").alias("s"), F.col("qe").alias("e"), number.cast("long").alias("block_number"))


@query(f"WITH {HITS} SELECT tid, CAST(sum(qe - qs) AS BIGINT) AS spliced_length FROM (SELECT DISTINCT tid, qs, qe FROM hits) GROUP BY tid")
def spliced_length(spark, sf_dir):
    return hits(spark, sf_dir).select("tid", "qs", "qe").distinct().groupBy("tid").agg(F.sum(F.col("qe") - F.col("qs")).alias("spliced_length"))


_WINDOWS = f"""WITH {HITS}, p AS (
  SELECT query_id, gene, greatest(0, qs - (3 * exon_len + 1) // 2) AS s, least(60000, qe + (3 * exon_len + 1) // 2) AS e FROM hits
), f AS (
  SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY query_id, gene ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM p
), n AS (SELECT *, sum(fresh) OVER (PARTITION BY query_id, gene ORDER BY s, e) AS k FROM f),
windows AS (SELECT query_id, gene, CAST(min(s) AS BIGINT) AS window_start, CAST(max(e) AS BIGINT) AS window_end FROM n GROUP BY query_id, gene, k)"""


def _windows(spark, sf_dir):
    pad = S.window_padding(F.col("exon_len"))
    padded = hits(spark, sf_dir).select(
        "query_id", "gene", F.greatest(F.lit(0), F.col("qs") - pad).alias("window_start"), F.least(F.lit(60000), F.col("qe") + pad).alias("window_end")
    )
    return merged(padded, ["query_id", "gene"], "window_start", "window_end", touching=True).drop("island")


@query(_WINDOWS + " SELECT * FROM windows")
def candidate_windows(spark, sf_dir):
    return _windows(spark, sf_dir)


@query(_WINDOWS + " SELECT h.query_id, h.gene, ok, ln, exon_id, window_start FROM hits h JOIN windows w ON h.query_id = w.query_id AND h.gene = w.gene AND h.qs >= window_start AND h.qe <= window_end")
def hits_in_windows(spark, sf_dir):
    rows = hits(spark, sf_dir).select("query_id", "gene", "ok", "ln", "exon_id", "qs", "qe")
    met = range_join(rows, _windows(spark, sf_dir), ["query_id", "gene"], 512, ("qs", "qe"), ("window_start", "window_end"), contained=True)
    return met.select("query_id", "gene", "ok", "ln", "exon_id", "window_start")


@query(
    _BLOCKS.replace("PARTITION BY query_id, strand", "PARTITION BY gene, exon_number, strand") + """, c AS (
  SELECT gene, exon_number, strand, max(block_id) AS k FROM n GROUP BY 1, 2, 3
), t AS (SELECT gene, exon_number, sum(k) AS k FROM c GROUP BY 1, 2),
x AS (SELECT p_brand AS gene, CAST(p_size AS BIGINT) AS exon_number FROM part GROUP BY 1, 2)
SELECT x.gene, min(coalesce(k, 0)) > 0 AND min(coalesce(k, 0)) = max(coalesce(k, 0)) AS balanced
FROM x LEFT JOIN t ON x.gene = t.gene AND x.exon_number = t.exon_number GROUP BY x.gene"""
)
def balanced_windows(spark, sf_dir):
    items = read_table(spark, sf_dir, "part").select(F.col("p_brand").alias("gene"), F.col("p_size").cast("long").alias("exon_number"))
    return equal_copy_counts(hits(spark, sf_dir), ["gene"], items, "exon_number", "strand", "qs", "qe")


@query(
    f"""WITH {HITS} SELECT a.ok, a.ln, a.exon_id,
  (SELECT max(b.qe) FROM hits b WHERE b.query_id = a.query_id AND b.strand = a.strand AND b.tid = a.tid AND b.exon_number = a.exon_number AND b.qe <= a.qs) AS previous_end,
  (SELECT min(b.qs) FROM hits b WHERE b.query_id = a.query_id AND b.strand = a.strand AND b.tid = a.tid AND b.exon_number = a.exon_number AND b.qs >= a.qe) AS next_start
FROM hits a"""
)
def copy_barriers(spark, sf_dir):
    """The nearest occurrences of the same exon number wholly before and behind each hit."""
    rows = hits(spark, sf_dir)
    keys = [*KEYS, "tid", "exon_number"]
    events = rows.select(*keys, F.struct("qs", "qe", "ok", "ln", "exon_id").alias("x"))
    ends = events.select(*keys, F.col("x.qe").alias("at"), F.lit(0).alias("kind"), F.col("x.qe").alias("end"), F.lit(None).cast("long").alias("start"), F.lit(None).cast(events.schema["x"].dataType).alias("x"))
    asks = events.select(*keys, F.col("x.qs").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("end"), F.lit(None).cast("long").alias("start"), "x")
    before = Window.partitionBy(*keys).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    first = ends.unionByName(asks).withColumn("previous_end", F.max("end").over(before)).where("kind = 1")
    starts = events.select(*keys, F.col("x.qs").alias("at"), F.lit(1).alias("kind"), F.col("x.qs").alias("start"), F.lit(None).cast("long").alias("previous_end"), F.lit(None).cast(events.schema["x"].dataType).alias("x"))
    again = first.select(*keys, F.col("x.qe").alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("start"), "previous_end", "x")
    behind = Window.partitionBy(*keys).orderBy("at", "kind").rowsBetween(0, Window.unboundedFollowing)
    both = starts.unionByName(again).withColumn("next_start", F.min("start").over(behind)).where("kind = 0")
    return both.select("x.ok", "x.ln", "x.exon_id", "previous_end", "next_start")


@query(
    f"""WITH {HITS}, o AS (SELECT *, CASE WHEN strand = '-' THEN -qe ELSE qs END AS s, CASE WHEN strand = '-' THEN -qs ELSE qe END AS e FROM hits)
SELECT p.ok AS p_ok, p.ln AS p_ln, h.ok AS h_ok, h.ln AS h_ln FROM o p JOIN o h
  ON p.query_id = h.query_id AND p.strand = h.strand AND p.tid = h.tid AND p.exon_number < h.exon_number AND p.e <= h.s
WHERE NOT EXISTS (SELECT 1 FROM o x WHERE x.query_id = p.query_id AND x.strand = p.strand AND x.tid = p.tid
  AND x.exon_number IN (p.exon_number, h.exon_number) AND x.s >= p.e AND x.e <= h.s
  AND NOT (x.ok = p.ok AND x.ln = p.ln) AND NOT (x.ok = h.ok AND x.ln = h.ln))"""
)
def chain_links(spark, sf_dir):
    """Which hit may follow which in a chain: rising numbers, no overlap, no other copy of either exon in the gap."""
    s, e = S.oriented(F.col("strand"), F.col("qs"), F.col("qe"))
    o = hits(spark, sf_dir).select(*KEYS, "tid", "exon_number", "ok", "ln", s.alias("s"), e.alias("e"))
    walled = with_barriers(o, [*KEYS, "tid"], "exon_number", "s", "e", beside=[*KEYS, "tid"])  # both sides of the join read one shuffle
    facts = ("exon_number", "s", "e", "later_end", "earlier_start")
    side = lambda x: walled.select(*KEYS, "tid", *[F.col(c).alias(f"{x}_{c}") for c in (*facts, "ok", "ln")])
    met = side("p").join(side("h"), [*KEYS, "tid"])
    return met.where(may_follow(*[[F.col(f"{x}_{c}") for c in facts] for x in "ph"])).select("p_ok", "p_ln", "h_ok", "h_ln")


# ---------------------------------------------------------------- call metrics and rows


@query(
    f"""WITH {HITS}, o AS (
  SELECT *, mane AS inserted, row_number() OVER (PARTITION BY query_id, strand, gene ORDER BY qs, qe, ok, ln) AS k,
         row_number() OVER (PARTITION BY query_id, strand, gene, mane ORDER BY qs, qe, ok, ln) AS j FROM hits
) SELECT query_id, strand, gene, k - j AS run, count(*) AS n_hits, count(DISTINCT exon_number) AS unique_numbers FROM o WHERE inserted GROUP BY 1, 2, 3, 4"""
)
def insertion_runs(spark, sf_dir):
    order = Window.partitionBy(*KEYS, "gene").orderBy("qs", "qe", "ok", "ln")
    own = Window.partitionBy(*KEYS, "gene", "mane").orderBy("qs", "qe", "ok", "ln")
    rows = hits(spark, sf_dir).withColumn("run", (F.row_number().over(order) - F.row_number().over(own)).cast("long")).where("mane")
    return rows.groupBy(*KEYS, "gene", "run").agg(F.count("*").alias("n_hits"), F.countDistinct("exon_number").alias("unique_numbers"))


@query(
    f"""WITH {HITS}, x AS (SELECT p_brand || ':' || p_type AS tid, count(DISTINCT p_size) AS expected FROM part GROUP BY 1),
c AS (SELECT query_id, strand, tid, count(DISTINCT exon_number) AS found, CAST(sum(ident) AS BIGINT) AS bases,
  round(sum(CAST(ident AS DOUBLE) * ident) / greatest(1, sum(ident)), 6) AS mean_identity FROM hits GROUP BY 1, 2, 3)
SELECT query_id, strand, c.tid, found, expected, expected - found AS missing, bases, mean_identity, round(CAST(found AS DOUBLE) / expected, 6) AS fraction FROM c JOIN x ON c.tid = x.tid"""
)
def call_metrics(spark, sf_dir):
    expected = read_table(spark, sf_dir, "part").groupBy(F.concat_ws(":", "p_brand", "p_type").alias("tid")).agg(F.countDistinct("p_size").alias("expected"))
    mean = F.sum(F.col("ident").cast("double") * F.col("ident")) / F.greatest(F.lit(1), F.sum("ident"))
    found = hits(spark, sf_dir).groupBy(*KEYS, "tid").agg(F.countDistinct("exon_number").alias("found"), F.sum("ident").alias("bases"), F.round(mean, 6).alias("mean_identity"))
    return found.join(expected, "tid").select(
        *KEYS, "tid", "found", "expected", (F.col("expected") - F.col("found")).alias("missing"), "bases", "mean_identity",
        F.round(F.col("found") / F.col("expected"), 6).alias("fraction"),
    )


@query(
    f"""WITH {HITS}, c AS (SELECT query_id, strand, gene, tid, count(DISTINCT exon_number) AS found, bool_or(mane) AS mane FROM hits GROUP BY 1, 2, 3, 4)
SELECT query_id, strand, gene, bool_and(found = 1) AND NOT bool_or(mane AND found >= 3) AS is_fragment FROM c GROUP BY 1, 2, 3"""
)
def fragment_routing(spark, sf_dir):
    calls = hits(spark, sf_dir).groupBy(*KEYS, "gene", "tid").agg(F.countDistinct("exon_number").alias("found"), F.bool_or("mane").alias("mane"))
    whole = F.bool_or(F.col("mane") & (F.col("found") >= 3))
    return calls.groupBy(*KEYS, "gene").agg((F.bool_and(F.col("found") == 1) & ~whole).alias("is_fragment"))


@query(
    f"""WITH {HITS} SELECT query_id, strand, qs, count(*) AS tie_count, string_agg(gene, ';' ORDER BY gene, tid, ok, ln) AS gene_ids,
  CASE WHEN count(DISTINCT exon_len) = 1 THEN CAST(min(exon_len) AS VARCHAR) ELSE string_agg(CAST(exon_len AS VARCHAR), ';' ORDER BY gene, tid, ok, ln) END AS lengths,
  min(qs) AS hull_start, max(qe) AS hull_end FROM hits GROUP BY query_id, strand, qs"""
)
def tied_union_rows(spark, sf_dir):
    members = F.sort_array(F.collect_list(F.struct("gene", "tid", "ok", "ln", F.col("exon_len").cast("string").alias("length"), "qe")))
    rows = hits(spark, sf_dir).groupBy(*KEYS, "qs").agg(members.alias("m"))
    lengths = F.col("m.length")
    return rows.select(
        *KEYS, "qs", F.size("m").cast("long").alias("tie_count"), F.array_join("m.gene", ";").alias("gene_ids"),
        F.when(F.size(F.array_distinct(lengths)) == 1, lengths[0]).otherwise(F.array_join(lengths, ";")).alias("lengths"),
        F.col("qs").alias("hull_start"), F.array_max("m.qe").alias("hull_end"),
    )


@query(
    f"""WITH {HITS} SELECT a.ok, a.ln, string_agg(DISTINCT b.gene, ',' ORDER BY b.gene) AS candidate_genes, min(b.qs) AS region_start, max(b.qe) AS region_end
FROM hits a JOIN hits b ON a.query_id = b.query_id AND a.strand = b.strand AND a.qs < b.qe AND b.qs < a.qe WHERE a.mane GROUP BY a.ok, a.ln"""
)
def overlap_groups(spark, sf_dir):
    rows = hits(spark, sf_dir)
    calls = rows.where("mane").select(*KEYS, "ok", "ln", F.col("qs").alias("s"), F.col("qe").alias("e"))
    evidence = rows.select(*KEYS, "gene", "qs", "qe")
    met = range_join(calls, evidence, KEYS, 64, ("s", "e"), ("qs", "qe"))
    genes = F.array_join(F.array_sort(F.collect_set("gene")), ",").alias("candidate_genes")
    return met.groupBy("ok", "ln").agg(genes, F.min("qs").alias("region_start"), F.max("qe").alias("region_end"))


@query(
    _BLOCKS.replace("PARTITION BY query_id, strand", "PARTITION BY query_id, strand, gene").format() + """, b AS (
  SELECT query_id, strand, gene, block_id, min(qs) AS s, max(qe) AS e, max(CAST(ident AS DOUBLE) / exon_len) AS frac FROM n GROUP BY 1, 2, 3, 4
), h AS (SELECT query_id, strand, gene, min(s) AS chrom_start, max(e) AS chrom_end, max(frac) AS frac, count(*) AS block_count FROM b GROUP BY 1, 2, 3)
SELECT h.query_id, h.strand, h.gene, chrom_start, chrom_end, block_count, CAST(greatest(0, least(1000, round_even(1000 * h.frac, 0))) AS INTEGER) AS score,
  string_agg(CAST(e - s AS VARCHAR), ',' ORDER BY s) AS block_sizes, string_agg(CAST(s - chrom_start AS VARCHAR), ',' ORDER BY s) AS block_starts
FROM h JOIN b ON h.query_id = b.query_id AND h.strand = b.strand AND h.gene = b.gene GROUP BY 1, 2, 3, 4, 5, 6, 7"""
)
def bed_blocks(spark, sf_dir):
    keys = [*KEYS, "gene"]
    numbered = islands(hits(spark, sf_dir), keys, "qs", "qe", False, "k")
    blocks = numbered.groupBy(*keys, "k").agg(F.min("qs").alias("s"), F.max("qe").alias("e"), F.max(F.col("ident") / F.col("exon_len")).alias("f"))
    rows = blocks.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("b"), F.collect_list("f").alias("f"))
    start = F.col("b")[0]["s"]
    return rows.select(
        *keys, start.alias("chrom_start"), F.array_max("b.e").alias("chrom_end"), F.size("b").cast("long").alias("block_count"), S.bed_score(F.col("f")).alias("score"),
        F.array_join(F.transform("b", lambda x: (x["e"] - x["s"]).cast("string")), ",").alias("block_sizes"),
        F.array_join(F.transform("b", lambda x: (x["s"] - start).cast("string")), ",").alias("block_starts"),
    )


# ---------------------------------------------------------------- sequences


@query(
    """WITH g AS (SELECT text, length(text) AS n FROM documents), r AS (SELECT d.*, row_number() OVER (PARTITION BY text, lang ORDER BY n_chars DESC, doc_id) AS k,
  count(*) OVER (PARTITION BY text, lang) AS copies FROM documents d) SELECT doc_id, lang, copies FROM r WHERE k = 1"""
)
def exact_sequence_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", F.sha2("text", 256).alias("key"))
    best = docs.groupBy("key", "lang").agg(F.min(F.struct((-F.col("n_chars")).alias("n"), "doc_id")).alias("b"), F.count("*").alias("copies"))
    return best.select("b.doc_id", "lang", "copies")


@query(
    """WITH s AS (SELECT source, lang, string_agg(DISTINCT CAST(n_chars % 7 AS VARCHAR), ',' ORDER BY CAST(n_chars % 7 AS VARCHAR)) AS members FROM documents GROUP BY 1, 2)
SELECT members, count(*) AS n_sets, min(source || '/' || lang) AS representative FROM s GROUP BY members"""
)
def identical_sets(spark, sf_dir):
    member = (F.col("n_chars") % 7).cast("string")
    sets = read_table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.array_join(F.array_sort(F.collect_set(member)), ",").alias("members"))
    return sets.groupBy("members").agg(F.count("*").alias("n_sets"), F.min(F.concat_ws("/", "source", "lang")).alias("representative"))


@query(
    f"""SELECT doc_id, sha256(reverse(translate(text, '{S.IUPAC}', '{S.COMPLEMENT}'))) AS reversed_sha256,
  CAST(length(regexp_replace(text, '[^ACGT]', '', 'g')) AS INTEGER) AS unmasked FROM documents"""
)
def revcomp_unmasked(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.sha2(S.reverse_complement(F.col("text")), 256).alias("reversed_sha256"), S.unmasked_bases(F.col("text")).alias("unmasked"))


@query(
    f"""WITH {HITS}, a AS (SELECT *, greatest(0, CAST(floor((150 - exon_len + 1) / 2.0) AS BIGINT)) AS want FROM hits)
SELECT ok, ln, least(want, qs) AS left_anchor, least(want, 26000 - qe) AS right_anchor FROM a"""
)
def anchor_lengths(spark, sf_dir):
    left, right = S.anchor_lengths(F.col("qs"), F.col("qe"), F.lit(26000).cast("long"))
    return hits(spark, sf_dir).select("ok", "ln", left.cast("long").alias("left_anchor"), right.cast("long").alias("right_anchor"))


@query(
    """WITH k AS (SELECT DISTINCT item_id, substr(text, 1 + i, 60) AS mer FROM (SELECT item_id, text, unnest(range(0, greatest(0, length(text) - 59), 20)) AS i FROM benchmark)),
d AS (SELECT doc_id, substr(text, 1 + i, 60) AS mer FROM (SELECT doc_id, text, unnest(range(0, greatest(0, length(text) - 59))) AS i FROM documents))
SELECT d.doc_id, k.item_id, count(*) AS n_seeds FROM k JOIN d ON k.mer = d.mer GROUP BY 1, 2"""
)
def kmer_seeds(spark, sf_dir):
    from lociweave.plans.search import shared_kmers

    seeds = shared_kmers(read_table(spark, sf_dir, "benchmark"), "item_id", read_table(spark, sf_dir, "documents"), "doc_id", "text", 60, 20)
    seeds = seeds.select("doc_id", "item_id", "target_at").distinct()  # a stretch that an item repeats is one
    return seeds.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_seeds"))


@query(
    """WITH k AS (SELECT item_id, i AS query_at, substr(text, 1 + i, 60) AS mer FROM (SELECT item_id, text, unnest(range(0, greatest(0, length(text) - 59), 20)) AS i FROM benchmark)),
d AS (SELECT doc_id, i AS target_at, substr(text, 1 + i, 60) AS mer FROM (SELECT doc_id, text, unnest(range(0, greatest(0, length(text) - 59))) AS i FROM documents))
SELECT d.doc_id, k.item_id, count(*) AS n_pairs, CAST(sum(query_at) AS BIGINT) AS query_sum, CAST(sum(target_at) AS BIGINT) AS target_sum FROM k JOIN d ON k.mer = d.mer GROUP BY 1, 2"""
)
def kmer_pairs(spark, sf_dir):
    """All pairs of places with equal stretches, repeated ones too."""
    from lociweave.plans.search import shared_kmers

    seeds = shared_kmers(read_table(spark, sf_dir, "benchmark"), "item_id", read_table(spark, sf_dir, "documents"), "doc_id", "text", 60, 20)
    sums = F.sum("query_at").alias("query_sum"), F.sum("target_at").alias("target_sum")
    return seeds.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_pairs"), *sums)


@query(
    """WITH c AS (SELECT doc_id, source, sum(strlen(text)) OVER (PARTITION BY source ORDER BY doc_id) - strlen(text) AS before, strlen(text) AS n FROM documents)
SELECT doc_id, source, CAST(before // 100000 AS BIGINT) AS batch FROM c"""
)
def query_batches(spark, sf_dir):
    from lociweave.plans.search import query_batches as batches

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", F.octet_length("text").cast("long").alias("n"))
    return batches(docs, ["source"], ["doc_id"], "n", 100_000).select("doc_id", "source", "batch")


@query("""SELECT p_partkey, regexp_replace('ENSE' || p_partkey || '.' || p_size, '\\.[0-9]+$', '') AS stripped FROM part""")
def strip_version_parse(spark, sf_dir):
    name = F.concat(F.lit("ENSE"), F.col("p_partkey").cast("string"), F.lit("."), F.col("p_size").cast("string"))
    return read_table(spark, sf_dir, "part").select("p_partkey", S.strip_version(name).alias("stripped"))


@query(
    """WITH s AS (SELECT user_id, event_id, event_type, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k,
  row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS j FROM events),
r AS (SELECT user_id, event_type, k - j AS g, min(k) AS first_k, count(*) AS n FROM s GROUP BY 1, 2, 3)
SELECT user_id, string_agg(CAST(n AS VARCHAR) || event_type, ' ' ORDER BY first_k) AS runs FROM r GROUP BY user_id"""
)
def cigar_runs(spark, sf_dir):
    """Run-length encoding of each user's event types in time order."""
    events = read_table(spark, sf_dir, "events")
    order, own = Window.partitionBy("user_id").orderBy("ts", "event_id"), Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    rows = events.select("user_id", "event_type", F.row_number().over(order).alias("k"), (F.row_number().over(order) - F.row_number().over(own)).alias("g"))
    runs = rows.groupBy("user_id", "event_type", "g").agg(F.min("k").alias("k"), F.count("*").alias("n"))
    text = F.concat(F.col("n").cast("string"), F.col("event_type"))
    return runs.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("k", text.alias("t")))).alias("r")).select("user_id", F.array_join("r.t", " ").alias("runs"))


@query(
    """WITH f AS (SELECT user_id, event_id, ts, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM f)
SELECT user_id, CAST(k AS BIGINT) AS session, count(*) AS n_events, CAST(epoch_us(min(ts)) AS BIGINT) AS first_us FROM n GROUP BY 1, 2"""
)
def session_islands(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = events.select("user_id", at.alias("s"), (at + 30 * 60 * 1_000_000).alias("e"))
    numbered = islands(rows, ["user_id"], "s", "e", touching=True, name="session")
    return numbered.groupBy("user_id", "session").agg(F.count("*").alias("n_events"), F.min("s").alias("first_us"))


@query(f"WITH {HITS} SELECT query_id % 10 AS sample, strand, count(*) AS n_rows, count(DISTINCT gene) AS n_genes, CAST(sum(ident) AS BIGINT) AS bases FROM hits GROUP BY 1, 2")
def sample_partition_rollup(spark, sf_dir):
    rows = hits(spark, sf_dir).withColumn("sample", F.col("query_id") % 10)
    return rows.groupBy("sample", "strand").agg(F.count("*").alias("n_rows"), F.countDistinct("gene").alias("n_genes"), F.sum("ident").alias("bases"))


@query(
    f"""WITH {HITS}, b AS (SELECT query_id, gene, max(ident) AS best FROM hits GROUP BY 1, 2),
r AS (SELECT query_id, gene, row_number() OVER (PARTITION BY query_id ORDER BY best DESC, gene) AS k FROM b)
SELECT ok, ln, h.query_id, h.gene FROM hits h JOIN r ON h.query_id = r.query_id AND h.gene = r.gene WHERE k <= 5"""
)
def target_cap(spark, sf_dir):
    """The rows of each query's five best targets: the cap is the operator."""
    from lociweave.plans.search import capped_targets

    return capped_targets(hits(spark, sf_dir).select("ok", "ln", "query_id", "gene", "ident"), "query_id", "gene", "ident", 5).select("ok", "ln", "query_id", "gene")


# ---------------------------------------------------------------- chains and resolution (not expressible in SQL)


def _chains(spark, sf_dir):
    """Transcript chains over the derived hits: types of a brand as transcripts, MANE if one of its parts is."""
    from lociweave.plans import calls as C

    found = with_blocks(hits(spark, sf_dir).drop("mane").withColumn("query_id", F.col("query_id").cast("string")), "qs", "qe")
    rows = with_block_scores(found, "gene", "exon_len", "ident", ["exon_id", "qs", "qe", "ok", "ln"])
    part = read_table(spark, sf_dir, "part").groupBy(F.concat_ws(":", "p_brand", "p_type").alias("tid")).agg(
        F.array_sort(F.collect_set(F.col("p_size").cast("int"))).alias("expected_numbers"), F.bool_or(F.col("p_partkey") % 5 == 0).alias("mane")
    )
    # blocks, scores and groups are made where the hits of a query and strand lie; what the columns of a hit say twice is added in the end
    own = F.struct(
        "qs", "qe", "ok", "ln", F.col("exon_number").cast("int").alias("number"), F.col("exon_id").cast("string").alias("exon_id"), "block_start", "block_end", "score", "exon_len", "ident",
        F.col("supplier_exon_id").cast("string").alias("supplier_exon_id"), "supplier_length",
    )
    groups = rows.groupBy("query_id", "strand", "tid", "gene").agg(F.sort_array(F.collect_list(own)).alias("h")).join(F.broadcast(part), "tid")

    def hit(x):
        identity = 100.0 * x["ident"] / x["exon_len"]
        return F.struct(
            x["number"].alias("number"), x["exon_id"].alias("exon_id"), x["qs"].alias("start"), x["qe"].alias("end"), x["block_start"].alias("block_start"), x["block_end"].alias("block_end"),
            x["score"].alias("score"), x["exon_len"].alias("length"), S.exon_score(x["exon_len"], x["ident"]).alias("exon_score"), x["ident"].alias("bases"), identity.alias("identity"),
            F.lit(100.0).alias("coverage"), x["ident"].cast("double").alias("alignment_score"), F.lit(0).cast("long").alias("exon_start"), x["exon_len"].alias("exon_end"),
            F.col("gene").alias("ref_chrom"), F.lit(0).cast("long").alias("ref_start"), x["exon_len"].alias("ref_end"), x["supplier_exon_id"].alias("supplier_exon_id"),
            x["supplier_length"].alias("supplier_length"),
        )

    length = F.aggregate("h", F.lit(0).cast("long"), lambda a, x: a + x["exon_len"])
    text = lambda v: F.lit(v)
    facts = groups.select(
        "query_id", "strand", "tid", F.col("tid").alias("transcript_id_full"), "gene", F.col("gene").alias("gene_id"), F.col("gene").alias("gene_id_full"), F.col("gene").alias("gene_name"),
        text("protein_coding").alias("transcript_type"), text("transcript").alias("model_type"), "mane", F.lit(True).alias("coding"), length.alias("exon_length"),
        F.size("expected_numbers").alias("expected"), "expected_numbers", F.lit(None).cast("long").alias("max_gap"), F.transform("h", hit).alias("hits"),
    )
    return C.chains(facts, 10.0, C.Options())


@query()
def chain_best(spark, sf_dir):
    """Every extracted chain: its found numbers and scores."""
    return _chains(spark, sf_dir).select("query_id", "strand", "tid", F.size("hits").alias("n_hits"), F.size("found").alias("n_found"), F.round("raw", 6).alias("raw"), F.round("weighted", 6).alias("weighted"))


@query()
def resolved_calls(spark, sf_dir):
    """The chains that stay after competition for blocks, with their tie groups."""
    from lociweave.plans import calls as C

    kept = C.resolved(C.lean(_chains(spark, sf_dir)), True)
    return kept.select("query_id", "strand", "tid", "gene", F.size("hits").alias("n_hits"), F.round("weighted", 6).alias("weighted"), "tie_group_id", "tie_count")


@query()
def same_exon_dedup(spark, sf_dir):
    """Of overlapping hits of one exon on one query and strand, the best and those that fit beside it."""
    rows = hits(spark, sf_dir).withColumn("score", S.exon_score(F.col("exon_len"), F.col("ident")))
    kept = non_overlapping(rows, [*KEYS, "exon_id"], "qs", "qe", [-F.col("score"), -F.col("ident"), F.col("ok"), F.col("ln")])
    return kept.select("ok", "ln", "exon_id", "qs", "qe")
