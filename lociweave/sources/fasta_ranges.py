"""FASTA files by byte ranges: contigs of any length come as numbered chunks, whether their lines are short or one line is the contig."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lociweave.operators.ranking import gapless_index
from lociweave.operators.stretches import CHUNK
from lociweave.storage import written

#: Bytes of a file that one task reads, and the longest header line.
RANGE, MOST_HEADER = 16 << 20, 1 << 16
FRAGMENTS = "path string, part long, record long, name string, place long, piece string"
_HEADER = re.compile(rb"^>[^\n]*\n?", re.MULTILINE)


class Range(InputPartition):
    def __init__(self, path: str, part: int, start: int, stop: int):
        self.path, self.part, self.start, self.stop = path, part, start, stop


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class FastaRangeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.range, self.size = options["path"], int(options.get("range", RANGE)), int(options.get("size", CHUNK))

    def partitions(self) -> list[Range]:
        store, name = opened(self.path)
        found = store.get_file_info(name)
        files = [found] if found.is_file else [i for i in store.get_file_info(fs.FileSelector(name)) if i.is_file and not i.base_name.startswith((".", "_"))]
        if found.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        return [Range(i.path, k, a, min(a + self.range, i.size)) for i in sorted(files, key=lambda i: i.path) for k, a in enumerate(range(0, i.size, self.range))]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        """Fragments of the range: record 0 goes on from the range before and has no name; place is a fragment's place in its record, as far as this range has it."""
        store = opened(self.path)[0]
        with store.open_input_file(part.path) as file:
            data = file.read_at(part.stop - part.start, part.start)
            back = min(part.start, MOST_HEADER)
            # which line the range begins in: it may be the rest of a header
            line = file.read_at(back, part.start - back).rpartition(b"\n")[2] if back else b""
            if line.startswith(b">"):
                data = data.partition(b"\n")[2]
            last = data.rfind(b"\n") + 1
            if data[last:].startswith(b">"):  # a header that goes on behind the range
                data += file.read_at(MOST_HEADER, part.stop).partition(b"\n")[0]
        marks = list(_HEADER.finditer(data))
        bounds = [0, *(m.end() for m in marks)], [*(m.start() for m in marks), len(data)]
        for record, (a, b) in enumerate(zip(*bounds, strict=True)):
            name = marks[record - 1].group()[1:].decode().split(maxsplit=1)[:1] if record else [None]
            bases = data[a:b].translate(None, b" \t\r\n\v\f").decode("ascii")
            places = range(0, max(1, len(bases)), self.size) if record or bases else range(0)
            columns = [[part.path] * len(places), [part.part] * len(places), [record] * len(places), [name[0] if name else ""] * len(places), list(places), [bases[p : p + self.size] for p in places]]
            types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["path", "part", "record", "name", "place", "piece"])


class FastaRanges(DataSource):
    """Fragments (FRAGMENTS) of a FASTA file or of the files of a folder; options: path, range (bytes a task), size (bases a fragment)."""

    @classmethod
    def name(cls) -> str:
        return "fasta_ranges"

    def schema(self) -> str:
        return FRAGMENTS

    def reader(self, schema) -> FastaRangeReader:
        return FastaRangeReader(self.options)


def fasta_chunks(spark: SparkSession, path: str, size: int = CHUNK, range_bytes: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """(chunks, contigs) of uncompressed FASTA: chunks (contig, chunk, piece) as operators.stretches has them, contigs (ordinal, contig, length).

    A contig's name is the first word of its header; ordinals count from 0 in the order of files and headers.  Bases keep their case; white
    space goes.  A contig without bases has one empty chunk.  Repeated or empty names, and bases before the first header of a file, are errors.
    No task holds more than a range of a file and no row more than a chunk, whatever the contig's length.
    """
    spark.dataSource.register(FastaRanges)
    rows = spark.read.format("fasta_ranges").option("path", path).option("range", str(range_bytes)).option("size", str(size)).load()
    found = written(rows, "fragments")
    # one row a range: how its last record goes on in the next range
    own = found.groupBy("path", "part", "record").agg(F.max("name").alias("name"), F.sum(F.length("piece")).cast("long").alias("n"))
    last = F.max_by(F.struct("name", "n"), "record").alias("last")
    ranges = own.groupBy("path", "part").agg(last, F.count_if(F.col("record") > 0).alias("headers"))
    order = Window.partitionBy("path").orderBy("part")
    here = order.rowsBetween(Window.unboundedPreceding, 0)
    grouped = ranges.withColumn("group", F.sum("headers").over(here)).withColumn("open", F.last("last.name", True).over(here))
    running = Window.partitionBy("path", "group").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    summed = grouped.withColumn("sum", F.sum("last.n").over(running))
    # a range without a fragment (all of it a header's rest) is not there, and its neighbours follow each other
    carried = summed.select(F.col("path").alias("_path"), F.col("part").alias("_part"), F.lag("open").over(order).alias("_name"), F.lag("sum").over(order).alias("_before"))
    met = found.join(carried, (F.col("path") == F.col("_path")) & (F.col("part") == F.col("_part")))
    goes_on = F.col("record") == 0
    contig = F.when(~goes_on, F.col("name")).otherwise(F.coalesce("_name", F.raise_error(F.lit("FASTA: bases before the first header"))))
    placed = met.select(contig.alias("contig"), (F.col("place") + F.when(goes_on, F.col("_before")).otherwise(0)).alias("at"), "piece")
    heads = gapless_index(own.where("record > 0").select("path", "part", "record", F.col("name").alias("contig")), [], ["path", "part", "record"], "ordinal")
    heads = written(heads.select("ordinal", "contig"), "heads")
    twice = heads.groupBy("contig").agg(F.count("*").alias("n")).where("n > 1 OR contig = ''").first()
    if twice:
        raise ValueError(f"FASTA: contig name {twice['contig']!r} is {'repeated' if twice['contig'] else 'empty'}")
    # fragments are cut at the contig's chunk bounds and put together by chunk
    n = F.length("piece").cast("long")
    parts = placed.withColumn("chunk", F.explode(F.sequence(F.expr(f"`at` div {size}"), F.floor((F.col("at") + F.greatest(n, F.lit(1)) - 1) / size))))
    low = F.greatest("at", F.col("chunk") * size)
    cut = F.col("piece").substr((low - F.col("at") + 1).cast("int"), F.least(F.lit(size).cast("long"), (F.col("chunk") + 1) * size - low).cast("int"))
    chunks = parts.select("contig", "chunk", F.struct(low.alias("at"), cut.alias("s")).alias("p")).groupBy("contig", "chunk").agg(F.array_sort(F.collect_list("p")).alias("p"))
    chunks = written(chunks.select("contig", "chunk", F.array_join("p.s", "").alias("piece")).where("chunk = 0 OR piece <> ''"), "chunks")
    lengths = chunks.groupBy("contig").agg(F.sum(F.length("piece")).cast("long").alias("length"))
    return chunks, heads.join(lengths, "contig").select("ordinal", "contig", "length")
