"""Stretches of long sequences: genomes are dealt as short chunks, and a place meets only the chunks that it lies in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bases of a chunk.  A character is found from the chunk's first one, so chunks are short; long ones are cut in steps,
#: as cutting a chromosome into short chunks at once would read it again for each of them.
CHUNK = 1 << 14
STEPS = (1 << 24, 1 << 19)


def chunks(genome: DataFrame, size: int = CHUNK) -> DataFrame:
    """(contig, chunk, piece): genome (name, seq) cut at multiples of size; an empty contig has one empty chunk.

    A table that has these columns already, of chunks of that size, is given back.
    """
    if genome.columns == ["contig", "chunk", "piece"]:
        return genome
    rows = genome.select(F.col("name").alias("contig"), F.lit(0).cast("long").alias("_from"), F.col("seq").alias("piece"))
    for step in [*[s for s in STEPS if s > size and s % size == 0], size]:
        last = F.floor(F.greatest(F.length("piece") - 1, F.lit(0)) / step).cast("long")
        each = rows.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        part = F.col("piece").substr((F.col("_k") * step + 1).cast("int"), F.lit(step))
        rows = each.select("contig", (F.col("_from") + F.col("_k") * step).alias("_from"), part.alias("piece"))
    return rows.select("contig", F.expr(f"_from div {size}").alias("chunk"), "piece")


def overlapping(genome: DataFrame, before: int, after: int, size: int = CHUNK) -> DataFrame:
    """(contig, length, start, own, until, piece): genome (name, seq) in parts of `size` with up to so many bases before and after them.

    start: where piece begins; own, until: the part itself.  Parts of a contig do not overlap, pieces do; rows without a
    sequence or with an empty one have none.  As in chunks(), long contigs are cut in steps.  genome may be a table of chunks (contig,
    chunk, piece) of that size; then only their ends travel, to the chunks beside them, which must be the longer ones.
    """
    if "piece" in genome.columns:
        return _overlapping_chunks(genome, before, after, size)
    rows = genome.where(F.length("seq") > 0).select(
        F.col("name").alias("contig"), F.length("seq").cast("long").alias("length"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("own"),
        F.length("seq").cast("long").alias("_until"), F.col("seq").alias("piece"),
    )
    for step in [*[s for s in STEPS if s > size and s % size == 0], size]:
        parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_until") - F.col("own") - 1) / step).cast("long"))
        each = rows.withColumn("_k", F.explode(parts)).withColumn("_own", F.col("own") + F.col("_k") * step).withColumn("_end", F.least(F.col("_until"), F.col("_own") + step))
        low = F.greatest(F.col("start"), F.col("_own") - before)
        piece = F.col("piece").substr((low - F.col("start") + 1).cast("int"), (F.col("_end") + after - low).cast("int"))
        rows = each.select("contig", "length", low.alias("start"), F.col("_own").alias("own"), F.col("_end").alias("_until"), piece.alias("piece"))
    return rows.select("contig", "length", "start", "own", F.col("_until").alias("until"), "piece")


def _overlapping_chunks(pieces: DataFrame, before: int, after: int, size: int) -> DataFrame:
    if max(before, after) > size:
        raise ValueError("surroundings reach beyond the next chunk")
    tails = pieces.select(F.col("contig").alias("_c"), (F.col("chunk") + 1).alias("_k"), F.expr(f"right(piece, {before})").alias("_tail"))
    heads = pieces.where("chunk > 0").select(F.col("contig").alias("_d"), (F.col("chunk") - 1).alias("_l"), F.expr(f"left(piece, {after})").alias("_head"))
    lengths = pieces.groupBy(F.col("contig").alias("_e")).agg(F.sum(F.length("piece")).cast("long").alias("length"))
    met = pieces.join(tails, (F.col("contig") == F.col("_c")) & (F.col("chunk") == F.col("_k")), "left")
    met = met.join(heads, (F.col("contig") == F.col("_d")) & (F.col("chunk") == F.col("_l")), "left").join(lengths, F.col("contig") == F.col("_e"))
    tail, own = F.coalesce("_tail", F.lit("")), F.col("chunk") * size
    return met.where("piece <> ''").select(
        "contig", "length", (own - F.length(tail)).alias("start"), own.alias("own"), (own + F.length("piece")).alias("until"), F.concat(tail, "piece", F.coalesce("_head", F.lit(""))).alias("piece")
    )


def with_length(rows: DataFrame, genome: DataFrame, contig: str) -> DataFrame:
    """rows with contig_length; rows of a contig that is not in the genome, (name, seq) or chunks, are left out."""
    if "piece" in genome.columns:
        lengths = genome.groupBy(F.col("contig").alias(contig)).agg(F.sum(F.length("piece")).cast("long").alias("contig_length"))
    else:
        lengths = genome.select(F.col("name").alias(contig), F.length("seq").cast("long").alias("contig_length"))
    return rows.join(lengths, contig)


def with_stretch(rows: DataFrame, genome: DataFrame, contig: str, start: str, end: str, into: str, size: int = CHUNK) -> DataFrame:
    """rows of with_length() with the stretch [start, end) of their contig, cut where it reaches outside.

    Contig names must be unique.  Rows without a place are left out; what ends before it starts is empty.  Equal places are cut once; only places
    and the chunks that they lie in travel, and whole rows meet their own stretch.
    """
    place = [contig, start, end]
    within = lambda c, low: F.least(F.greatest(F.col(c), low), F.col("contig_length"))
    wanted = rows.select(*place, "contig_length").distinct().where(F.col(start).isNotNull() & F.col(end).isNotNull())
    wanted = wanted.withColumn("_a", within(start, F.lit(0).cast("long"))).withColumn("_b", within(end, F.col("_a")))
    first = F.least("_a", F.greatest(F.col("contig_length") - 1, F.lit(0)))
    chunk = lambda c: F.floor(c / size).cast("long")
    met = wanted.withColumn("chunk", F.explode(F.sequence(chunk(first), chunk(F.greatest(F.col("_b") - 1, first)))))
    met = met.join(chunks(genome, size).withColumnRenamed("contig", contig), [contig, "chunk"])
    low = F.greatest(F.lit(0).cast("long"), F.col("_a") - F.col("chunk") * size)
    high = F.least(F.lit(size).cast("long"), F.col("_b") - F.col("chunk") * size)
    cut = F.col("piece").substr((low + 1).cast("int"), F.greatest(F.lit(0).cast("long"), high - low).cast("int"))
    pieces = met.select(*place, F.struct("chunk", cut.alias("s")).alias("_p")).groupBy(*place).agg(F.array_sort(F.collect_list("_p")).alias("_p"))
    return rows.join(pieces.select(*place, F.array_join("_p.s", "").alias(into)), place)
