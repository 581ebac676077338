import re

from conftest import SF

from lociweave import storage
from lociweave.operators.intervals import islands
from lociweave.plans.derived import hits
from lociweave.plans.search import window_balance


def test_islands_are_dealt_by_the_size_of_their_input(spark, monkeypatch):
    rows, keys = hits(spark, SF).select("query_id", "strand", "qs", "qe", "ok", "ln"), ["query_id", "strand"]
    plain = sorted(map(tuple, islands(rows, keys, "qs", "qe").select(*keys, "qs", "island").collect()))
    size = storage.file_bytes(rows)
    assert size > 0
    monkeypatch.setattr(storage, "EACH", size // 20)
    wide = islands(rows, keys, "qs", "qe")
    assert storage.input_width(rows) >= 20 and f", {storage.input_width(rows)})" in wide._jdf.queryExecution().toString()
    assert sorted(map(tuple, wide.select(*keys, "qs", "island").collect())) == plain


def test_window_balance_deals_windows_by_input(spark, tmp_path, monkeypatch):
    windows = [(f"g{g}", f"c{c}", s, s + 100) for g in range(3) for c in range(5) for s in (0, 200)]
    rows = [(g, c, e, "+", s + 10 * e, s + 10 * e + 5) for g, c, s, _ in windows for e in range(2)]
    paths = [str(tmp_path / n) for n in ("windows", "hits")]
    spark.createDataFrame(windows, "gene string, contig string, window_start long, window_end long").write.parquet(paths[0])
    spark.createDataFrame(rows, "gene string, contig string, exon long, strand string, start long, end long").write.parquet(paths[1])
    made, found = map(spark.read.parquet, paths)
    expected = spark.createDataFrame([(f"g{g}", e) for g in range(3) for e in range(2)], "gene string, exon long")
    monkeypatch.setattr(storage, "EACH", storage.file_bytes(found) // 20)
    balance = window_balance(made, found, expected, 64)
    plan = balance._jdf.queryExecution().executedPlan().toString()
    dealt = [int(n) for n in re.findall(r"Exchange hashpartitioning\([^)]*contig[^)]*, (\d+)\)", plan)]
    assert len(dealt) >= 3 and min(dealt) >= 20
    assert balance.count() == len(windows) and balance.where("balanced").count() == len(windows)
