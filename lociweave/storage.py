"""Tables written to the folder all executors share, used to cut lineage and to keep what is used twice."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no spark.checkpoint.dir and runs in one process (tests, a laptop).
LOCAL_CHECKPOINTS = "file:///tmp/checkpoints"
#: The shuffle files of a table that has been written are of no more use, and go when its job ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Batches that go to Python are cut by bytes, as rows may be of any length; the default cuts at 10,000 rows.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_paths: list[str] = []
WHILE_WRITING = {FREE_SHUFFLES: "true", BATCH_BYTES: str(4 << 20)}


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under spark.checkpoint.dir, which driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = LOCAL_CHECKPOINTS
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _paths.append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Delete all that this process wrote to the shared folder; frames read from it are of no more use."""
    for path in _paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _paths.clear()


def drop(table: DataFrame) -> None:
    """Delete the files of a table that `written` gave and that nothing reads any more."""
    spark = table.sparkSession
    for path in {f.rpartition("/")[0] for f in table.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: later jobs neither recompute nor lose it."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = {key: spark.conf.get(key) for key in WHILE_WRITING}
    for key, value in WHILE_WRITING.items():
        spark.conf.set(key, value)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of input files for each partition of a shuffle that is dealt by the size of its input.
EACH = 8 << 20


def file_bytes(table: DataFrame) -> int:
    """Bytes of the files that table is made from."""
    spark = table.sparkSession
    conf, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in table.inputFiles()]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def input_width(*tables: DataFrame) -> int:
    """Partitions for a shuffle of these tables, one for EACH bytes of their files, so that what a task sorts does not grow with the input."""
    return max(-(-file_bytes(t) // EACH) for t in tables)


def dealt(table: DataFrame, width: int, keys: list[str]) -> DataFrame:
    """table dealt by keys to `width` partitions, where that is more than a shuffle has anyway; windows, groups and joins by keys use it as it is."""
    return table.repartition(width, *keys) if width > shuffle_width(table.sparkSession) else table


def together(table: DataFrame, width: int, keys: list[str]) -> DataFrame:
    """table dealt by keys, to `width` partitions where that is more than a shuffle has anyway: what groups or joins by these keys and more stays in its task."""
    return dealt(table, width, keys) if width > shuffle_width(table.sparkSession) else table.repartition(*keys)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
