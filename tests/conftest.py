import sys
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tmp_path_factory.mktemp("shared").as_uri()).getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    return made


def rows_of(frame):
    """Rows of a pandas frame as sorted tuples of text, columns by name."""
    frame = frame[sorted(frame.columns)].astype(object)
    cell = lambda v: "" if pd.isna(v) else str(int(v)) if isinstance(v, float) and v.is_integer() else str(v)
    return sorted(tuple(cell(v) for v in row) for row in frame.itertuples(index=False))


@pytest.fixture(scope="session")
def oracle():
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return lambda sql: rows_of(con.sql(sql).df())
