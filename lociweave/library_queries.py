"""Queries that run the library's call, report, annotation and database plans over the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.operators.barriers import insertion_run_sets, with_barriers
from lociweave.plans import annotation as A
from lociweave.plans import calls as C
from lociweave.plans import exon_database as D
from lociweave.plans import reports as R
from lociweave.plans import resolution, search
from lociweave.plans.derived import HITS, SPANS, hits, spans
from lociweave.plans.evidence import known_exons, select_alignments
from lociweave.queries import KEYS, query
from lociweave.storage import input_width, read_table, together, written

_ORDER = "ORDER BY qs, qe, ok, ln"
_MODELS = "x AS (SELECT p_brand || ':' || p_type AS tid, count(DISTINCT p_size) AS expected, bool_or(p_partkey % 5 = 0) AS mane FROM part GROUP BY 1)"


def _collected(spark, sf_dir) -> DataFrame:
    """One row a query, strand and transcript: `h`, its hits in no order, and what is expected of it.

    Hits are dealt by query and strand, with what the columns of a hit say but once; so genes are put together where their transcripts are.
    """
    models = read_table(spark, sf_dir, "part").groupBy(F.concat_ws(":", "p_brand", "p_type").alias("tid")).agg(
        F.array_sort(F.collect_set(F.col("p_size").cast("int"))).alias("expected_numbers"), F.bool_or(F.col("p_partkey") % 5 == 0).alias("mane")
    )
    rows = hits(spark, sf_dir).select(
        F.col("query_id").cast("string").alias("query_id"), "strand", "tid", "gene", "qs", "qe", "ok", "ln", F.col("exon_number").cast("int").alias("number"), F.col("exon_id").cast("string").alias("exon_id"), "exon_len", "ident"
    )
    own = F.struct("qs", "qe", "ok", "ln", "number", "exon_id", "exon_len", "ident")
    groups = together(rows, input_width(rows), KEYS).groupBy(*KEYS, "tid", "gene").agg(F.collect_list(own).alias("h"))
    return groups.join(F.broadcast(models), "tid")


def _hit(x):
    """A hit as calls have it: a block of its own, scored by its length."""
    number = lambda c: c.cast("double")
    return F.struct(
        x["number"].alias("number"), x["exon_id"].alias("exon_id"), x["qs"].alias("start"), x["qe"].alias("end"), x["qs"].alias("block_start"), x["qe"].alias("block_end"),
        number(x["exon_len"]).alias("score"), x["exon_len"].alias("length"), number(x["exon_len"]).alias("exon_score"), x["ident"].alias("bases"), number(x["ident"]).alias("identity"),
        F.lit(100.0).alias("coverage"), number(x["ident"]).alias("alignment_score"), F.lit(0).cast("long").alias("exon_start"), x["exon_len"].alias("exon_end"), F.col("gene").alias("ref_chrom"),
        F.lit(0).cast("long").alias("ref_start"), x["exon_len"].alias("ref_end"), x["exon_id"].alias("supplier_exon_id"), x["exon_len"].alias("supplier_length"),
    )


def _groups(spark, sf_dir) -> DataFrame:
    """One row a query, strand and transcript with its hits; every hit is a block of its own, scored by its length."""
    return _collected(spark, sf_dir).select(
        *KEYS, "tid", F.col("tid").alias("transcript_id_full"), "gene", F.col("gene").alias("gene_id"), F.col("gene").alias("gene_id_full"), F.col("gene").alias("gene_name"),
        F.lit("protein_coding").alias("transcript_type"), F.when(F.col("tid").endswith("SMALL"), "full_gene").otherwise("transcript").alias("model_type"), "mane",
        F.lit(True).alias("coding"), F.lit(7).cast("long").alias("exon_length"), F.size("expected_numbers").alias("expected"), "expected_numbers",
        F.lit(None).cast("long").alias("max_gap"), F.transform(F.sort_array("h"), _hit).alias("hits"),
    )


def _scored(spark, sf_dir) -> DataFrame:
    """Each group as one call; calls of a query, strand and gene are one assignment."""

    parts = {"parent": F.concat_ws("|", "query_id", "strand", "gene"), "coding_x": F.lit(10.0), "complete_x": F.lit(2.0), "mane_x": F.lit(1.0)}
    groups = _groups(spark, sf_dir).withColumns(parts | {"hits": F.transform("hits", lambda h: h.withField("inserted", F.lit(False))), "runs": F.array().cast("array<int>")})
    facts = {c: F.col(c) for c in ("expected", "coding", "mane", "coding_x", "complete_x", "mane_x")}
    return written(groups.withColumns(resolution.scores_of(F.col("hits"), facts)), "calls")


def _calls(spark, sf_dir) -> DataFrame:
    """The scored calls with what their assignment has of all of them."""
    made = _scored(spark, sf_dir)
    hull = made.groupBy("parent").agg(
        F.max("weighted").alias("sort_score"), F.min(F.array_min("hits.block_start")).alias("hull_start"), F.max(F.array_max("hits.block_end")).alias("hull_end")
    )
    return made.join(hull, "parent").withColumns({"tie_group_id": F.lit(""), "tie_count": F.lit(1)})


_CALLS = f"""WITH {HITS}, {_MODELS}, r AS (
  SELECT query_id, strand, tid, sum(qe - qs) AS raw FROM (SELECT DISTINCT query_id, strand, tid, qs, qe FROM hits) GROUP BY 1, 2, 3
), c AS (
  SELECT CAST(h.query_id AS VARCHAR) AS q, h.strand, h.tid, h.gene, x.expected, x.mane, h.tid LIKE '%SMALL' AS model, count(DISTINCT exon_number) AS found,
         string_agg(CAST(exon_number AS VARCHAR), ',' {_ORDER}) AS numbers, string_agg(qs || '-' || qe, ',' {_ORDER}) AS places,
         string_agg(CAST(exon_id AS VARCHAR), ',' {_ORDER}) AS ids, sum(ident) AS bases, count(DISTINCT (qs, qe)) AS blocks,
         CASE WHEN sum(ident) > 0 THEN CAST(sum(ident * ident) AS DOUBLE) / sum(ident) ELSE 0.0 END AS identity, min(qs) AS a, max(qe) AS b, any_value(raw) AS raw
  FROM hits h JOIN x ON h.tid = x.tid JOIN r ON h.query_id = r.query_id AND h.strand = r.strand AND h.tid = r.tid GROUP BY 1, 2, 3, 4, 5, 6, 7
), d AS (SELECT *, q || '|' || strand || '|' || gene AS parent, CAST(raw AS DOUBLE) * 10.0 * (CASE WHEN expected <= found THEN 2.0 ELSE 1.0 END) AS weighted FROM c),
p AS (SELECT parent, max(weighted) AS s, max(q) AS q, min(a) AS a, max(b) AS b,
             bool_and(NOT model OR (expected > found AND blocks = 1)) AND NOT bool_or(NOT model AND expected <= found AND mane) AS is_fragment FROM d GROUP BY parent),
n AS (SELECT *, row_number() OVER (ORDER BY s DESC, q DESC, a, b, parent DESC) AS k FROM p)"""


@query(
    _CALLS + """ SELECT printf('GENE_%06d', k) AS GENE_index, CASE WHEN model THEN gene ELSE tid END AS transcript_id, gene AS gene_id, d.q AS query_id, strand, numbers AS found_exon_numbers,
  places AS exon_query_coordinates, ids AS exon_ids, printf('%.6f', CAST(raw AS DOUBLE)) AS raw_exon_score, printf('%.6f', weighted) AS weighted_score, CAST(bases AS VARCHAR) AS total_aligned_bases,
  printf('%.6f', identity) AS mean_identity, CAST(expected AS VARCHAR) AS expected_exons, CAST(found AS VARCHAR) AS found_exons, CAST(expected - found AS VARCHAR) AS missing_exons,
  printf('%.6f', CAST(found AS DOUBLE) / expected) AS fraction_expected_found, CAST(CASE WHEN model THEN n.a ELSE d.a END AS VARCHAR) AS query_start,
  CAST(CASE WHEN model THEN n.b ELSE d.b END AS VARCHAR) AS query_end, CASE WHEN expected = found THEN 'complete' ELSE 'partial' END AS call_status, is_fragment
FROM d JOIN n ON d.parent = n.parent"""
)
def call_rows(spark, sf_dir):
    """The call table of one call a transcript: metrics, routing, numbering."""
    table = R.call_table(C.routed(_calls(spark, sf_dir), True))
    return table.select(
        "GENE_index", "transcript_id", "gene_id", "query_id", "strand", "found_exon_numbers", "exon_query_coordinates", "exon_ids", "raw_exon_score", "weighted_score", "total_aligned_bases",
        "mean_identity", "expected_exons", "found_exons", "missing_exons", "fraction_expected_found", "query_start", "query_end", "call_status", "is_fragment",
    )


def _tied_table(spark, sf_dir) -> DataFrame:
    """The call table with all transcripts of an assignment tied."""
    calls = _calls(spark, sf_dir).where("model_type = 'transcript'")
    many = calls.groupBy("parent").agg(F.count("*").cast("int").alias("_n"))
    tied = calls.drop("tie_count", "tie_group_id").join(many, "parent").withColumns({"tie_count": F.col("_n"), "tie_group_id": F.when(F.col("_n") > 1, "t").otherwise("")}).drop("_n")
    return R.call_table(C.routed(tied, True))


_BY = "ORDER BY tid, a, b"
_TIED = _CALLS + f""", t AS (
  SELECT parent, q, strand, any_value(gene) AS gene, count(*) AS members, string_agg(tid, ';' {_BY}) AS tids, string_agg(gene, ';' {_BY}) AS genes, string_agg(numbers, ';' {_BY}) AS numbers,
         string_agg(places, ';' {_BY}) AS places, min(a) AS a, max(b) AS b, bool_and(mane) AS mane, max(CAST(printf('%.6f', CAST(found AS DOUBLE) / expected) AS DOUBLE)) AS fraction,
         CASE WHEN count(DISTINCT expected) = 1 THEN CAST(min(expected) AS VARCHAR) ELSE string_agg(CAST(expected AS VARCHAR), ';' {_BY}) END AS expecteds,
         CASE WHEN count(DISTINCT expected = found) = 1 THEN any_value(CASE WHEN expected = found THEN 'complete' ELSE 'partial' END)
              ELSE string_agg(CASE WHEN expected = found THEN 'complete' ELSE 'partial' END, ';' {_BY}) END AS status
  FROM d WHERE NOT model GROUP BY parent, q, strand)"""


@query(
    _TIED + """ SELECT tids AS transcript_id, genes AS gene_id, q AS query_id, strand, numbers AS found_exon_numbers, places AS exon_query_coordinates, CAST(a AS VARCHAR) AS query_start,
  CAST(b AS VARCHAR) AS query_end, CAST(members AS VARCHAR) AS tie_count, CASE WHEN members > 1 THEN 'tied' ELSE 'unique' END AS assignment_status, expecteds AS expected_exons, status AS call_status FROM t"""
)
def tied_rows(spark, sf_dir):
    """Tied calls of an assignment in one row of the call table."""
    return _tied_table(spark, sf_dir).select(
        "transcript_id", "gene_id", "query_id", "strand", "found_exon_numbers", "exon_query_coordinates", "query_start", "query_end", "tie_count", "assignment_status", "expected_exons", "call_status"
    )


@query(
    _TIED + """, e AS (SELECT parent, members, CAST(string_split(v, '-')[1] AS BIGINT) AS s, CAST(string_split(v, '-')[2] AS BIGINT) AS e, i
  FROM (SELECT parent, members, unnest(string_split(replace(places, ';', ','), ',')) AS v, unnest(range(0, len(string_split(replace(places, ';', ','), ',')))) AS i FROM t)),
f AS (SELECT *, CASE WHEN members = 1 OR s > max(e) OVER (PARTITION BY parent ORDER BY s, e, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS fresh FROM e),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY parent ORDER BY s, e, i ROWS UNBOUNDED PRECEDING) AS k FROM f),
m AS (SELECT parent, k, min(s) AS s, max(e) AS e FROM g GROUP BY parent, k)
SELECT t.q AS chrom, t.a AS "chromStart", t.b AS "chromEnd", genes || '|' || tids || '|' || status AS name, CAST(greatest(0, least(1000, round_even(1000 * fraction, 0))) AS INTEGER) AS score,
  CASE WHEN mane THEN '0,102,204' ELSE '96,96,96' END AS "itemRgb", CAST(count(*) AS INTEGER) AS "blockCount", string_agg(CAST(m.e - m.s AS VARCHAR), ',' ORDER BY m.s, m.e) || ',' AS "blockSizes",
  string_agg(CAST(m.s - t.a AS VARCHAR), ',' ORDER BY m.s, m.e) || ',' AS "blockStarts"
FROM t JOIN m ON t.parent = m.parent GROUP BY t.parent, t.q, t.a, t.b, genes, tids, status, fraction, mane"""
)
def bed_rows(spark, sf_dir):
    """BED of the tied call table: blocks of tied rows are merged where they meet."""
    return R.bed(_tied_table(spark, sf_dir)).select("chrom", "chromStart", "chromEnd", "name", "score", "itemRgb", "blockCount", "blockSizes", "blockStarts")


@query(
    f"""WITH {HITS}, p AS (SELECT a.query_id, a.strand, a.gene, a.tid, b.tid AS c_tid, b.gene AS c_gene, b.gene || ':0-' || b.exon_len AS c_exon, least(a.qs, b.qs) AS s, greatest(a.qe, b.qe) AS e
  FROM hits a JOIN hits b ON a.query_id = b.query_id AND a.strand = b.strand AND a.qs < b.qe AND b.qs < a.qe),
u AS (SELECT DISTINCT query_id, strand, gene, tid, s, e FROM p),
f AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY query_id, strand, gene, tid ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM u),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY query_id, strand, gene, tid ORDER BY s, e) AS k FROM f),
m AS (SELECT query_id, strand, gene, tid, k, min(s) AS s, max(e) AS e FROM n GROUP BY 1, 2, 3, 4, 5),
r AS (SELECT query_id, strand, gene, tid, string_agg(s || '-' || e, ',' ORDER BY s) AS overlap_regions FROM m GROUP BY 1, 2, 3, 4)
SELECT CAST(p.query_id AS VARCHAR) AS query_id, p.strand, p.tid AS reported_transcript_id, string_agg(DISTINCT c_tid, ',' ORDER BY c_tid) AS candidate_transcript_ids,
  string_agg(DISTINCT c_gene, ',' ORDER BY c_gene) AS candidate_gene_ids, string_agg(DISTINCT c_exon, ',' ORDER BY c_exon) AS candidate_reference_exons, any_value(overlap_regions) AS overlap_regions
FROM p JOIN r ON p.query_id = r.query_id AND p.strand = r.strand AND p.gene = r.gene AND p.tid = r.tid GROUP BY p.query_id, p.strand, p.gene, p.tid"""
)
def overlap_group_rows(spark, sf_dir):
    """Evidence that overlaps each call's hits."""
    evidence = hits(spark, sf_dir).select(
        F.col("query_id").cast("string").alias("query_id"), "strand", "tid", "gene", F.col("exon_id").cast("string").alias("exon_id"), F.col("gene").alias("chrom"), F.lit(0).alias("start0"),
        F.col("exon_len").alias("end0"), F.col("qs").alias("query_start"), F.col("qe").alias("query_end"),
    )
    found = R.overlap_groups(_scored(spark, sf_dir), evidence, 64)
    return found.select("query_id", "strand", "reported_transcript_id", "candidate_transcript_ids", "candidate_gene_ids", "candidate_reference_exons", "overlap_regions")


# ---------------------------------------------------------------- chains

_ORIENTED = f"WITH {{recursive}}{HITS}, o AS (SELECT *, CASE WHEN strand = '-' THEN -qe ELSE qs END AS s, CASE WHEN strand = '-' THEN -qs ELSE qe END AS e FROM hits)"


@query(
    _ORIENTED.format(recursive="") + """ SELECT CAST(a.query_id AS VARCHAR) AS query_id, a.strand, a.tid, a.exon_number AS number, a.qs, a.qe, a.exon_id,
  (SELECT min(b.e) FROM o b WHERE b.query_id = a.query_id AND b.strand = a.strand AND b.tid = a.tid AND b.exon_number = a.exon_number AND b.s >= a.e) AS later_end,
  (SELECT max(b.s) FROM o b WHERE b.query_id = a.query_id AND b.strand = a.strand AND b.tid = a.tid AND b.exon_number = a.exon_number AND b.e <= a.s) AS earlier_start FROM o a"""
)
def exon_walls(spark, sf_dir):
    """The copy barriers that the transcript chain uses."""
    start, end = S.oriented(F.col("strand"), F.col("qs"), F.col("qe"))
    rows = hits(spark, sf_dir).select(F.col("query_id").cast("string").alias("query_id"), "strand", "tid", F.col("exon_number").alias("number"), "qs", "qe", "exon_id", start.alias("s"), end.alias("e"))
    return with_barriers(rows, [*KEYS, "tid"], "number", "s", "e").drop("s", "e")


@query(
    _ORIENTED.format(recursive="RECURSIVE ") + """, i AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY ok, ln, query_id, strand, tid, qs, qe, exon_id) AS id FROM o),
l AS (SELECT p.id AS p_id, h.id, h.exon_len FROM i p JOIN i h
  ON p.query_id = h.query_id AND p.strand = h.strand AND p.tid = h.tid AND p.exon_number < h.exon_number AND p.e <= h.s
  WHERE NOT EXISTS (SELECT 1 FROM i x WHERE x.query_id = p.query_id AND x.strand = p.strand AND x.tid = p.tid
    AND x.exon_number IN (p.exon_number, h.exon_number) AND x.s >= p.e AND x.e <= h.s AND x.id NOT IN (p.id, h.id))),
w AS (SELECT query_id, strand, tid, id, exon_len AS score, 1 AS n FROM i
  UNION ALL SELECT w.query_id, w.strand, w.tid, l.id, w.score + l.exon_len, w.n + 1 FROM w JOIN l ON w.id = l.p_id),
b AS (SELECT query_id, strand, tid, max(score) AS score FROM w GROUP BY 1, 2, 3)
SELECT CAST(b.query_id AS VARCHAR) AS query_id, b.strand, b.tid, CAST(b.score AS DOUBLE) AS raw, CAST(max(w.n) AS INTEGER) AS n_hits
FROM b JOIN w ON b.query_id = w.query_id AND b.strand = w.strand AND b.tid = w.tid AND b.score = w.score GROUP BY 1, 2, 3, 4"""
)
def first_chains(spark, sf_dir):
    """The best transcript chain of each group, against all chains that SQL can enumerate."""
    groups = _groups(spark, sf_dir).withColumn("model_type", F.lit("transcript"))
    return C.chains(groups, 10.0, C.Options(max_chains=1)).select(*KEYS, "tid", "raw", F.size("hits").alias("n_hits"))


@query(
    f"""WITH RECURSIVE {HITS}, c AS MATERIALIZED (SELECT query_id, strand, tid, query_id || strand || tid AS call, count(*) AS n FROM hits GROUP BY 1, 2, 3),
b AS MATERIALIZED (SELECT DISTINCT c.query_id, c.strand, call, n, qs, qe FROM hits JOIN c USING (query_id, strand, tid)),
e AS MATERIALIZED (SELECT DISTINCT x.call AS one, y.call AS other FROM b x JOIN b y ON x.query_id = y.query_id AND x.strand = y.strand AND x.n = y.n AND x.qs = y.qs AND x.qe = y.qe AND x.call <> y.call),
r AS (SELECT call, call AS met FROM c UNION SELECT r.call, e.other FROM r JOIN e ON r.met = e.one),
m AS (SELECT call, min(met) AS component FROM r GROUP BY call)
SELECT CAST(query_id AS VARCHAR) AS query_id, strand, tid, n AS n_hits, component, count(*) OVER (PARTITION BY component) AS tie_count FROM c JOIN m USING (call)"""
)
def tie_components(spark, sf_dir):
    """Transcripts of a query and strand with equally many hits that share a hit's place, directly or through others."""
    rows = hits(spark, sf_dir).withColumn("query_id", F.col("query_id").cast("string"))
    call = F.concat("query_id", "strand", "tid").alias("call")
    calls = written(rows.groupBy(*KEYS, "tid").agg(F.count("*").alias("n_hits")).select(*KEYS, "tid", call, "n_hits", F.col("n_hits").cast("double").alias("score")), "calls")
    blocks = rows.select(call, *KEYS, F.col("qs").alias("block_start"), F.col("qe").alias("block_end")).distinct()
    found = resolution.tie_components(resolution.with_rank(calls, KEYS, F.lit(False), "score"), blocks, KEYS, "call")
    return found.select(*KEYS, "tid", "n_hits", "component", "tie_count")


@query()
def gene_chain_best(spark, sf_dir):
    """Gene edit chains with insertions and a gap limit, brands as genes."""
    placed = F.transform("h", lambda x: F.struct(*[x[c].alias(c) for c in ("qs", "exon_id", "qe", "ok", "ln", "number", "exon_len", "ident")]))
    numbers = F.array_sort(F.array_distinct(F.flatten(F.collect_list("expected_numbers")))).alias("expected_numbers")
    genes = _collected(spark, sf_dir).groupBy(*KEYS, "gene").agg(F.sort_array(F.flatten(F.collect_list(placed))).alias("h"), numbers)
    names = {c: F.col("gene") for c in ("tid", "transcript_id_full", "gene_id", "gene_id_full", "gene_name")}
    genes = genes.withColumns(names | {
        "transcript_type": F.lit("protein_coding"), "model_type": F.lit("full_gene"), "mane": F.lit(False), "coding": F.lit(True), "exon_length": F.lit(1).cast("long"),
        "expected": F.size("expected_numbers"), "max_gap": F.lit(5000).cast("long"), "hits": F.transform("h", _hit),
    })
    made = C.chains(genes.drop("h"), 1.0, C.Options())
    return made.select(*KEYS, "tid", F.size("hits").alias("n_hits"), F.size("found").alias("n_found"), F.col("runs").cast("string").alias("runs"), F.round("raw", 6).alias("raw"))


@query(
    f"""WITH {HITS}, o AS (SELECT *, CASE WHEN strand = '-' THEN -qe ELSE qs END AS s, CASE WHEN strand = '-' THEN -qs ELSE qe END AS e FROM hits),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id, strand, gene ORDER BY s, e, exon_number, qs, qe, ok, ln) - row_number() OVER (PARTITION BY query_id, strand, gene, mane ORDER BY s, e, exon_number, qs, qe, ok, ln) AS run FROM o),
r AS (SELECT query_id, strand, gene, run, min(s) AS s, min((s, e, exon_number, ok, ln)) AS pos, string_agg(DISTINCT CAST(exon_number AS VARCHAR), ',' ORDER BY CAST(exon_number AS VARCHAR)) AS labels FROM k WHERE mane GROUP BY 1, 2, 3, 4)
SELECT CAST(query_id AS VARCHAR) AS query_id, strand, gene, string_agg(labels, ';' ORDER BY pos) AS runs FROM r GROUP BY 1, 2, 3"""
)
def insertion_run_labels(spark, sf_dir):
    """Labels of the runs of inserted hits; hits of MANE parts count as inserted."""
    start, end = S.oriented(F.col("strand"), F.col("qs"), F.col("qe"))
    rows = hits(spark, sf_dir).withColumns({"query_id": F.col("query_id").cast("string"), "s": start, "e": end})
    runs = insertion_run_sets(rows, [*KEYS, "gene"], ["s", "e", "exon_number", "qs", "qe", "ok", "ln"], "mane", "exon_number")
    labels = F.array_join(F.array_sort(F.transform("numbers", lambda n: n.cast("string"))), ",")
    listed = runs.groupBy(*KEYS, "gene").agg(F.array_sort(F.collect_list(F.struct("run", labels.alias("labels")))).alias("r"))
    return listed.select(*KEYS, "gene", F.array_join("r.labels", ";").alias("runs"))


# ---------------------------------------------------------------- annotation and database


def _exons(spark, sf_dir, exon, chrom, placed=False) -> DataFrame:
    """Hits as rows of an annotation, in the order (ok, ln); placed: those equal in it in the order of the files."""
    return hits(spark, sf_dir, placed).select(
        F.struct("ok", "ln", *(["file", "row"] if placed else [])).alias("ord"), exon.alias("exon_id_full"), exon.alias("exon_id"), chrom.alias("chrom"), F.col("qs").alias("start0"), F.col("qe").alias("end0"), "strand", "tid",
        F.col("tid").alias("transcript_id_full"), F.col("exon_number").cast("int").alias("exon_number"), F.col("gene").alias("gene_id"), F.col("gene").alias("gene_id_full"),
        F.col("gene").alias("gene_name"), F.when(F.col("ln") % 2 == 0, "protein_coding").otherwise("lncRNA").alias("transcript_type"), F.col("mane").alias("own_mane"),
    )


@query(f"WITH {HITS} SELECT tid, CAST(sum(qe - qs) AS BIGINT) AS exon_length FROM (SELECT DISTINCT tid, query_id, qs, qe FROM hits) GROUP BY tid")
def spliced_lengths(spark, sf_dir):
    return A.spliced_lengths(_exons(spark, sf_dir, F.col("exon_id").cast("string"), F.col("query_id")))


@query(
    f"""WITH {HITS}, k AS (SELECT *, exon_id % 20 AS e FROM hits),
t AS (SELECT e, qs, qe, strand, tid, gene, min((ok, ln)) AS pos FROM k GROUP BY ALL),
g AS (SELECT e, qs, qe, strand, gene, min((ok, ln)) AS pos FROM k GROUP BY ALL),
a AS (SELECT e, qs, qe, strand, string_agg(tid, ',' ORDER BY pos) AS tids FROM t GROUP BY ALL), b AS (SELECT e, qs, qe, strand, string_agg(gene, ',' ORDER BY pos) AS genes FROM g GROUP BY ALL),
c AS (SELECT e, qs, qe, strand, bool_or(ln % 2 = 0) AS coding, bool_or(mane) AS any_mane FROM k GROUP BY ALL)
SELECT CAST(c.e AS VARCHAR) AS exon_id, c.qs AS start0, c.qe AS end0, c.strand, tids AS transcript_ids, genes AS gene_ids, coding, any_mane FROM c
JOIN a ON c.e = a.e AND c.qs = a.qs AND c.qe = a.qe AND c.strand = a.strand JOIN b ON c.e = b.e AND c.qs = b.qs AND c.qe = b.qe AND c.strand = b.strand"""
)
def collapsed_exons(spark, sf_dir):
    """One row an exon id and place, lists distinct by (ok, ln) and, where rows are equal in it, in file order."""
    rows = _exons(spark, sf_dir, (F.col("exon_id") % 20).cast("string"), F.lit("c"), placed=True).where("exon_id IS NOT NULL AND start0 IS NOT NULL AND end0 IS NOT NULL")
    # a brand or a type that is null makes no name, and no number is behind all others
    rows = rows.withColumns({
        "tid": F.when(F.col("tid") != F.col("gene_id"), F.col("tid")), "ord": F.struct(F.col("ord.ok").isNull(), "ord.ok", F.col("ord.ln").isNull(), "ord.ln", "ord.file", "ord.row"),
        "transcript_type": F.when(F.col("ord.ln").isNotNull(), F.col("transcript_type")),
    })
    made = D.collapse_exons(rows)
    listed = lambda c: F.when(F.exists(c, lambda x: x.isNotNull()), F.array_join(c, ",")).alias(c)
    return made.select("exon_id", "start0", "end0", "strand", listed("transcript_ids"), listed("gene_ids"), "coding", "any_mane")


@query(
    """WITH d AS (SELECT doc_id, text, n_chars, lang, n_chars % 50 AS unmasked FROM documents)
SELECT doc_id, first_value(CAST(doc_id AS VARCHAR)) OVER (PARTITION BY text, lang, n_chars ORDER BY unmasked DESC, CAST(doc_id AS VARCHAR)) AS representative FROM d WHERE text IS NOT NULL"""
)
def sequence_representatives(spark, sf_dir):
    """The representative of each group of equal sequences (texts) and anchors (languages)."""
    docs = read_table(spark, sf_dir, "documents").where("text IS NOT NULL").select(
        "doc_id", F.col("doc_id").cast("string").alias("exon_id_full"), F.col("text").alias("sequence"), F.col("lang").alias("left_anchor"), F.lit(0).alias("right_anchor"),
        F.lit("c").alias("chrom"), F.lit(0).alias("start0"), F.col("n_chars").alias("end0"), F.lit("+").alias("strand"), (F.col("n_chars") % 50).alias("unmasked"),
    )
    return D.sequence_groups(docs).select("doc_id", "representative")


@query(
    f"""WITH {HITS}, k AS (SELECT DISTINCT query_id, strand, gene, exon_id, qs, qe FROM hits),
f AS (SELECT *, CASE WHEN qs < max(qe) OVER (PARTITION BY query_id, strand, gene ORDER BY qs, qe, exon_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM k),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY query_id, strand, gene ORDER BY qs, qe, exon_id) AS i FROM f),
u AS (SELECT query_id, strand, gene, i, min(qs - CASE WHEN strand = '-' THEN 20 ELSE 10 END) AS a, max(qe + CASE WHEN strand = '-' THEN 10 ELSE 20 END) AS b, count(*) AS members FROM n GROUP BY 1, 2, 3, 4)
SELECT CAST(n.exon_id AS VARCHAR) AS exon_id, n.query_id AS chrom, n.strand, qs AS start0, a AS query_start0, b AS query_end0, members, CASE WHEN n.strand = '-' THEN b - qe ELSE qs - a END AS core_start,
  CASE WHEN n.strand = '-' THEN b - qs ELSE qe - a END AS core_end FROM n JOIN u ON n.query_id = u.query_id AND n.strand = u.strand AND n.gene = u.gene AND n.i = u.i"""
)
def union_query_places(spark, sf_dir):
    """Search queries that hold the overlapping exons of a gene, and each exon's place in its query."""
    exons = hits(spark, sf_dir).select("query_id", "strand", "gene", "exon_id", "qs", "qe").distinct().select(
        F.col("exon_id").cast("string").alias("exon_id"), F.col("exon_id").cast("string").alias("exon_id_full"), F.col("query_id").alias("chrom"), "strand", F.col("qs").alias("start0"),
        F.col("qe").alias("end0"), F.array("gene").alias("gene_names"), F.array("gene").alias("gene_ids"), F.lit(10).cast("long").alias("left_anchor"), F.lit(20).cast("long").alias("right_anchor"),
    )
    return D.union_queries(exons).select("exon_id", "chrom", "strand", "start0", "query_start0", "query_end0", "members", "core_start", "core_end")


@query(
    f"""WITH {HITS}, k AS (SELECT *, CAST(query_id % 3 AS VARCHAR) AS chrom FROM hits),
f AS (SELECT *, CASE WHEN qs < max(qe) OVER (PARTITION BY gene, chrom, strand ORDER BY qs, qe, ok, ln ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM k),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY gene, chrom, strand ORDER BY qs, qe, ok, ln) AS i FROM f),
b AS (SELECT gene, chrom, strand, i, min(qs) AS a, max(qe) AS z, string_agg(DISTINCT CAST(exon_id AS VARCHAR), ',' ORDER BY CAST(exon_id AS VARCHAR)) AS exons,
      string_agg(DISTINCT tid, ',' ORDER BY tid) AS tids FROM n GROUP BY 1, 2, 3, 4),
l AS (SELECT gene, chrom, strand, row_number() OVER (PARTITION BY gene ORDER BY chrom, strand) AS k, count(*) OVER (PARTITION BY gene) AS loci, m FROM (SELECT gene, chrom, strand, max(i) AS m FROM b GROUP BY 1, 2, 3))
SELECT b.gene || '_full_gene' || CASE WHEN loci > 1 THEN '_' || k ELSE '' END AS transcript_id, b.gene AS gene_id, b.chrom AS reference_contig, b.strand,
  CAST(CASE WHEN b.strand = '-' THEN m + 1 - i ELSE i END AS INTEGER) AS exon_number, a AS start, z AS "end", exons AS source_exon_ids, tids AS source_transcript_ids
FROM b JOIN l ON b.gene = l.gene AND b.chrom = l.chrom AND b.strand = l.strand"""
)
def full_gene_report(spark, sf_dir):
    """The union of a gene's exons at each locus, as numbered blocks."""
    exons = written(_exons(spark, sf_dir, F.col("exon_id").cast("string"), (F.col("query_id") % 3).cast("string")), "exons")
    transcripts = exons.select("tid").distinct().withColumn("model_type", F.lit("transcript"))
    report = A.full_gene_models(A.Annotation(exons, transcripts))[2]
    return report.select("transcript_id", "gene_id", "reference_contig", "strand", "exon_number", "start", "end", "source_exon_ids", "source_transcript_ids")


@query(
    f"""WITH RECURSIVE {SPANS}, m AS (
  SELECT loc, gene, s, e, CASE WHEN s <= max(e) OVER (PARTITION BY loc, gene ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM spans
), g AS (SELECT loc, gene, s, e, sum(fresh) OVER (PARTITION BY loc, gene ORDER BY s, e) AS k FROM m), u AS (SELECT loc, gene, min(s) AS s, max(e) AS e FROM g GROUP BY loc, gene, k),
pairs AS (SELECT a.loc, a.gene AS x, b.gene AS y, sum(least(a.e, b.e) - greatest(a.s, b.s)) AS shared FROM u a JOIN u b ON a.loc = b.loc AND a.gene < b.gene AND a.s < b.e AND b.s < a.e GROUP BY 1, 2, 3),
edges AS (SELECT loc, x, y, shared FROM pairs WHERE shared > 14 UNION SELECT loc, y, x, shared FROM pairs WHERE shared > 14),
reach AS (SELECT DISTINCT loc, x AS node, x AS seen FROM edges UNION SELECT r.loc, r.node, e.y FROM reach r JOIN edges e ON e.loc = r.loc AND e.x = r.seen),
o AS (SELECT loc, node, min(seen) AS root FROM reach GROUP BY 1, 2),
n AS (SELECT o.loc, root, string_agg('g' || lpad(CAST(node AS VARCHAR), 4, '0'), '&' ORDER BY node) AS unit FROM o GROUP BY 1, 2),
t AS (SELECT o.loc, root, max(shared) AS shared FROM edges JOIN o ON o.loc = edges.loc AND o.node = edges.x GROUP BY 1, 2)
SELECT o.loc AS chrom, 'g' || lpad(CAST(node AS VARCHAR), 4, '0') AS gene_id, unit AS unit_id, CAST(t.shared AS BIGINT) AS shared FROM o JOIN n ON o.loc = n.loc AND o.root = n.root JOIN t ON o.loc = t.loc AND o.root = t.root"""
)
def shared_gene_units(spark, sf_dir):
    """Genes that share more than 14 exonic bases, directly or through others, as one unit."""
    gene = F.concat(F.lit("g"), F.lpad(F.col("gene").cast("string"), 4, "0"))
    exons = spans(spark, sf_dir).select(
        F.col("loc").alias("chrom"), F.lit("+").alias("strand"), gene.alias("gene_id"), gene.alias("gene_name"), gene.alias("gene_id_full"), F.col("s").alias("start0"), F.col("e").alias("end0"), F.col("s").alias("ord")
    )
    return A.shared_exon_units(exons, 14, 64).select("chrom", "gene_id", "unit_id", "shared")


@query(
    """WITH s AS (SELECT p_type, min(p_brand) AS lead, string_agg(DISTINCT p_brand, ';' ORDER BY p_brand) AS members FROM part WHERE p_size = 50 GROUP BY 1),
m AS (SELECT lead, unnest(string_split(members, ';')) AS member FROM s)
SELECT p_partkey, p_brand AS gene_id, coalesce(lead || 'merged', p_brand) AS gene_name FROM part LEFT JOIN (SELECT DISTINCT lead FROM s) l ON p_brand = l.lead
WHERE p_brand NOT IN (SELECT member FROM m WHERE member <> lead)"""
)
def paralog_representatives(spark, sf_dir):
    """Members of paralog sets go, the representative takes the merged name."""
    part = read_table(spark, sf_dir, "part")
    brands = F.array_sort(F.collect_set("p_brand"))
    report = part.where("p_size = 50").groupBy("p_type").agg(brands.alias("b")).select(
        F.col("b")[0].alias("representative_gene_id"), F.concat(F.col("b")[0], F.lit("merged")).alias("merged_gene_name"), F.array_join("b", ";").alias("gene_ids")
    )
    genes = part.select("p_partkey", F.col("p_brand").alias("gene_id"), F.col("p_brand").alias("gene_name"))
    return A.with_representatives(A.Annotation(genes, genes), report).exons.select("p_partkey", "gene_id", "gene_name")


# ---------------------------------------------------------------- selection and sequences


@query(
    f"""WITH {HITS} SELECT coalesce(CASE WHEN NOT (exon_len > 5) THEN 'AS' WHEN NOT (CAST(ident AS DOUBLE) * 100 / exon_len > 95) THEN 'identity' WHEN NOT (least(100, 80 + ok % 30) >= 90) THEN 'coverage' END, 'kept') AS outcome,
  count(*) AS n FROM hits GROUP BY 1"""
)
def alignment_selection(spark, sf_dir):
    """Alignments by the first rule that rejects them."""
    rows = hits(spark, sf_dir).select(
        F.col("exon_len").cast("double").alias("AS"), (F.col("ident").cast("double") * 100 / F.col("exon_len")).alias("percent_identity"),
        F.least(F.lit(100), 80 + F.col("ok") % 30).cast("double").alias("exon_coverage"),
    )
    found = select_alignments(rows, least_score=5.0)
    return found.groupBy(F.coalesce("rejected", F.lit("kept")).alias("outcome")).agg(F.count("*").alias("n"))


@query(f"WITH {HITS} SELECT ok, ln, exon_id FROM hits WHERE exon_id IN (SELECT p_partkey FROM part WHERE p_size <= 10)")
def known_exon_rows(spark, sf_dir):
    known = read_table(spark, sf_dir, "part").where("p_size <= 10").select(F.col("p_partkey").alias("exon_id"))
    return known_exons(hits(spark, sf_dir), known).select("ok", "ln", "exon_id")


@query(
    """WITH c AS (SELECT user_id, CASE WHEN event_id % 7 = 0 THEN '-' ELSE substr(event_type, 1, 1) END AS q, CASE WHEN event_id % 5 = 0 AND event_id % 7 <> 0 THEN '-' ELSE substr(event_type, 2, 1) END AS t, ts, event_id FROM events),
k AS (SELECT *, CASE WHEN q = '-' THEN 'I' WHEN t = '-' THEN 'D' WHEN q = t THEN '=' ELSE 'X' END AS kind, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM c),
r AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, kind ORDER BY i) AS g FROM k),
n AS (SELECT user_id, kind, g, min(i) AS pos, count(*) AS n FROM r GROUP BY 1, 2, 3)
SELECT user_id, string_agg(n || kind, '' ORDER BY pos) AS cigar FROM n GROUP BY user_id"""
)
def alignment_cigars(spark, sf_dir):
    """CIGAR of two gapped rows of letters a user, made of the user's events."""
    events = read_table(spark, sf_dir, "events")
    q = F.when(F.col("event_id") % 7 == 0, "-").otherwise(F.substring("event_type", 1, 1))
    t = F.when((F.col("event_id") % 5 == 0) & (F.col("event_id") % 7 != 0), "-").otherwise(F.substring("event_type", 2, 1))
    rows = events.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", q.alias("q"), t.alias("t")))).alias("c"))
    kind = events.schema["user_id"].dataType.simpleString()

    def one(row: dict) -> list[dict]:
        letters = lambda s: search.np.frombuffer(s.encode(), search.np.uint8)
        return [{"user_id": row["user_id"], "cigar": search.runs_of(letters(row["q"]), letters(row["t"]))}]

    return C._map_rows(rows.select("user_id", F.array_join("c.q", "").alias("q"), F.array_join("c.t", "").alias("t")), one, f"user_id {kind}, cigar string")


@query(f"WITH {HITS} SELECT ok, ln, round(CAST(greatest(0, least(qe, 5000) - greatest(qs, 4980)) AS DOUBLE) / greatest(qe - qs, 20), 6) AS share FROM hits")
def reciprocal_overlaps(spark, sf_dir):
    share = S.reciprocal_overlap(F.col("qs"), F.col("qe"), F.lit(4980), F.lit(5000))
    return hits(spark, sf_dir).select("ok", "ln", F.round(share, 6).alias("share"))


@query(
    f"""WITH {HITS}, n AS (SELECT *, CASE WHEN query_id % 2 = 0 THEN 's' || query_id || '_' || qs || '_' || qe ELSE 'plain_' || query_id END AS name FROM hits)
SELECT ok, ln, CASE WHEN query_id % 2 = 0 THEN 's' || query_id ELSE name END AS contig, CASE WHEN query_id % 2 = 0 THEN qs ELSE 0 END AS shift,
  contains(name, 's1') AND qs < 9000 AND qe > 3000 AS inside FROM n"""
)
def located_queries(spark, sf_dir):
    """Names with a place in them, and rows of a region."""
    name = F.when(F.col("query_id") % 2 == 0, F.concat(F.lit("s"), F.concat_ws("_", "query_id", "qs", "qe"))).otherwise(F.concat(F.lit("plain_"), F.col("query_id").cast("string")))
    rows = hits(spark, sf_dir).withColumn("name", name)
    contig, shift = S.query_location(F.col("name"))
    chrom, low, high = S.parse_region("s1:9,000-3,000/rc")
    return rows.select("ok", "ln", contig.alias("contig"), shift.alias("shift"), S.in_region(F.col("name"), F.col("qs"), F.col("qe"), chrom, low, high).alias("inside"))
