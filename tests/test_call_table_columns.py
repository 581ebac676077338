from conftest import SF, rows_of
from lociweave import queries


def test_call_tables_are_made_of_columns(spark):
    plan = queries.queries()["call_rows"](spark, SF)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan


def test_overlap_groups_are_those_of_all_transcripts(spark, oracle):
    wanted = oracle("SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS query_id, CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '+' END AS strand, p_brand || ':' || p_type AS tid FROM lineitem JOIN part ON l_partkey = p_partkey")
    found = queries.queries()["overlap_group_rows"](spark, SF).selectExpr("query_id", "strand", "reported_transcript_id AS tid")
    assert rows_of(found.toPandas()) == wanted
