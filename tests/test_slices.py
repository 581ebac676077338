import pyarrow as pa

from lociweave.plans import calls as C


def test_batches_become_python_objects_a_slice_at_a_time(spark):
    batch = pa.RecordBatch.from_pylist([{"text": "x" * 100_000, "k": k} for k in range(100)])
    parts = list(C._slices(batch))
    assert sum(p.num_rows for p in parts) == 100 and max(p.nbytes for p in parts) <= C.SLICE_BYTES
    assert [k for p in parts for k in p.column("k").to_pylist()] == list(range(100))
    assert list(C._slices(batch.slice(0, 0))) == []
    assert [p.num_rows for p in C._slices(pa.RecordBatch.from_pylist([{"text": "x" * 3_000_000}]))] == [1]
    # a slice keeps its own rows, so the rows that f makes of each are the same in every slicing
    rows = spark.range(0, 2000).selectExpr("id", "repeat('x', 2000) AS text").coalesce(1)
    made = C._map_rows(rows, lambda r: [{"id": r["id"], "n": len(r["text"])}], "id long, n int").collect()
    assert sorted(map(tuple, made)) == [(k, 2000) for k in range(2000)]
