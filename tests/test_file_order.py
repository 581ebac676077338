"""Hits of one order key and line number are listed as they lie in the files."""

from pathlib import Path

import duckdb
import pytest

from conftest import SF, rows_of
from lociweave import queries, storage
from lociweave.plans import derived


@pytest.mark.parametrize("files,large", [(1, derived.LARGE), (3, derived.LARGE), (3, 0)])
def test_collapsed_exons_with_equal_order_follow_the_files(spark, tmp_path, monkeypatch, files, large):
    monkeypatch.setattr(derived, "LARGE", large)
    monkeypatch.setattr(storage, "EACH", storage.EACH if large else 1 << 10)
    con = duckdb.connect()
    con.sql("SET threads = 1")
    con.sql(f"COPY (SELECT * FROM '{SF}/part.parquet') TO '{tmp_path}/part.parquet'")
    # all rows of an exon share place and order, so only the files tell which comes first
    con.sql(f"""CREATE TABLE l AS SELECT * REPLACE (CAST(1 AS BIGINT) AS l_orderkey, 2 AS l_linenumber, 7.0 AS l_quantity, TIMESTAMP '1995-01-02' AS l_shipdate)
                FROM (SELECT *, file_row_number AS n FROM read_parquet('{SF}/lineitem.parquet', file_row_number = true)) ORDER BY n""")
    Path(f"{tmp_path}/lineitem.parquet").mkdir()
    for k in range(files):
        con.sql(f"COPY (SELECT * EXCLUDE (n, file_row_number) FROM l WHERE n >= {k} * 6000 // {files} AND n < {k + 1} * 6000 // {files} ORDER BY n) TO '{tmp_path}/lineitem.parquet/{k}.parquet'")
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    con.sql(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet'")
    wanted = rows_of(con.sql(queries.oracle_sql()["collapsed_exons"]).df())
    assert len(wanted) == 20 and max(row[-1].count(",") for row in wanted) > 3
    assert rows_of(queries.queries()["collapsed_exons"](spark, str(tmp_path)).toPandas()) == wanted


def test_collapsed_exons_with_nulls_equal_the_sql(spark, tmp_path):
    con = duckdb.connect()
    con.sql("SET threads = 1")
    gaps = lambda key, names: ", ".join(f"CASE WHEN ({key} * {k + 3}) % {31 + k} = 0 THEN NULL ELSE {n} END AS {n}" for k, n in enumerate(names))
    con.sql(f"COPY (SELECT * REPLACE ({gaps('p_partkey', ['p_brand', 'p_type', 'p_size'])}) FROM '{SF}/part.parquet') TO '{tmp_path}/part.parquet'")
    con.sql(f"""COPY (SELECT * EXCLUDE (n) REPLACE ({gaps('n', ['l_orderkey', 'l_partkey', 'l_linenumber', 'l_quantity', 'l_shipdate'])})
                FROM (SELECT * EXCLUDE (file_row_number) REPLACE (date_trunc('year', l_shipdate) AS l_shipdate), file_row_number AS n FROM read_parquet('{SF}/lineitem.parquet', file_row_number = true)) ORDER BY n)
                TO '{tmp_path}/lineitem.parquet'""")
    for name in ("lineitem", "part"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    wanted = rows_of(con.sql(queries.oracle_sql()["collapsed_exons"]).df())
    assert rows_of(queries.queries()["collapsed_exons"](spark, str(tmp_path)).toPandas()) == wanted
