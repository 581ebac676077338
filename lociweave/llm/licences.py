"""License scans: TF-IDF cosine of licence statements to templates, and nearest-ancestor inheritance by path joins.

DataFrame functions only.  A text is read line by line, its leading comment block and a licence file's whole text also as
one piece, and in windows of as many words
as a template has, across lines and inside them, that begin where one of the template's anchor words would stand in its
place; a window is compared with its template alone.  An SPDX-License-Identifier tag with the name of a template's licence
(-only, -or-later or + behind it or not) states that licence, with score 1; of an expression the first name counts.
Pieces and templates are sparse vectors over lower-cased words.  A word's weight is 1 + ln((1 + N) / (1 + df)), with df counted over all N texts,
for the words of the templates and for every other word of a piece alike.

A piece's cosine is at most the length of the template's part that the piece has, over the template's length.  So the
commonest words of a template, up to a part shorter than the threshold, cannot make a match by themselves, and a piece
is compared only if it has one of the other words (the anchors).  That leaves no match out, however common a notice is.

A file takes the licence of its best piece from THRESHOLD up.  A header speaks for its file alone; a directory has the
licence of its licence files (by name, the first by path that states one), and a file without a licence of its own inherits
from the nearest directory at or above its place that has one.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lociweave.storage import written

THRESHOLD = 0.6
LICENCE_FILE = "(?i)^(licen[cs]es?|copying|notice|unlicense)([.-].*)?$"
#: How a line of a comment begins.
COMMENT = r"^[ \t]*(#|//|/\*|\*|--|;|<!--|%|\(\*|\")"

#: Licence statements by SPDX name (fixed values): the usual one-line notices and the openings of the full texts.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work (CC0 1.0)."),
]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _weight(n: int, df: Column) -> Column:
    return 1 + F.log((1 + F.lit(float(n))) / (1 + df))


def template_squares(terms: list[Row], df: dict[str, int], n: int) -> dict[int, dict[str, float]]:
    """Squared weight of each word of each template.  terms: rows of template_table."""
    of: dict[int, dict[str, float]] = {}
    for r in terms:
        of.setdefault(r["template"], {})[r["word"]] = (r["tf"] * (1 + log((1 + n) / (1 + df.get(r["word"], 0))))) ** 2
    return of


def least_square(squares: dict[str, float], threshold: float) -> float:
    """Squared length of a template's part that a piece must have to reach the threshold."""
    return max(0.0, threshold - 1e-6) ** 2 * sum(squares.values())  # scores are rounded to six places


def anchors_of(squares: dict[str, float], df: dict[str, int], threshold: float) -> set[str]:
    """Words of which a piece must have one to reach the threshold for this template."""
    anchors: set[str] = set()
    room = least_square(squares, threshold)
    for word in sorted(squares, key=lambda w: (-df.get(w, 0), w)):
        if squares[word] < room:
            room -= squares[word]
        else:
            anchors.add(word)
    return anchors


def anchor_words(terms: list[Row], df: dict[str, int], n: int, threshold: float) -> list[str]:
    """Words of which a piece must have one to reach the threshold for some template."""
    return sorted(set().union(*(anchors_of(s, df, threshold) for s in template_squares(terms, df, n).values())))


def windows(
    texts: DataFrame, templates: list[tuple[str, str]], squares: dict[int, dict[str, float]], df: dict[str, int], threshold: float
) -> DataFrame:
    """(key, of, piece, words): windows of texts (key, text) that have enough of template `of` for the threshold."""
    spark = texts.sparkSession
    bodies = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(templates)], "of int, body string")
    placed = []  # a row for each place of an anchor in a template
    for r in bodies.select("of", _words(F.col("body")).alias("words")).collect():
        own = squares[r["of"]]
        anchors, least = anchors_of(own, df, threshold), least_square(own, threshold)
        placed += [(w, r["of"], i, len(r["words"]), list(own.items()), least) for i, w in enumerate(r["words"]) if w in anchors]
    places = spark.createDataFrame(placed, "word string, of int, place int, size int, squares array<struct<word: string, square: double>>, least double")
    anchors = sorted({row[0] for row in placed})
    at = texts.select("key", _words(F.col("text")).alias("all")).select("key", "all", F.posexplode("all").alias("at", "word"))
    met = at.where(F.col("word").isin(anchors)).join(F.broadcast(places), "word")
    begin = F.greatest(F.col("at") - F.col("place"), F.lit(0))
    cut = met.select("key", "of", F.slice("all", begin + 1, F.col("size")).alias("words"), "squares", "least")
    held = F.aggregate("squares", F.lit(0.0), lambda a, e: a + F.when(F.array_contains("words", e["word"]), e["square"]).otherwise(0.0))
    found = cut.where(held >= F.col("least")).select("key", "of", F.xxhash64("words").alias("piece"), "words")
    return found.dropDuplicates(["key", "of", "piece"])


def tagged(files: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """(key, licence, score) of the SPDX tags in files (key, text) that name a template's licence."""
    names = sorted({name for name, _ in templates})
    known = F.broadcast(files.sparkSession.createDataFrame([(n.lower(), n) for n in names], "name string, licence string"))
    tags = F.regexp_extract_all("text", F.lit(r"(?i)SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9.+-]+)"), F.lit(1))
    each = files.where(F.lower("text").contains("spdx-license-identifier")).select("key", F.explode(tags).alias("tag"))
    plain = F.regexp_replace(F.lower("tag"), r"(-only|-or-later|\+)$", "")
    return each.select("key", plain.alias("name")).join(known, "name").select("key", "licence", F.lit(1.0).alias("score"))


def pieces_of(name: Column, text: Column) -> Column:
    """Lines of a text, its leading comment block if that has several lines, and all of it if it is a licence file."""
    lines = F.split(text, "\n")
    other = F.array_position(F.transform(lines, lambda line: ~line.rlike(COMMENT)), True)
    header = F.when(other == 0, F.size(lines)).otherwise(other - 1).cast("int")
    block = F.when(header > 1, F.array(F.array_join(F.slice(lines, 1, header), "\n"))).otherwise(F.array())
    return F.concat(lines, block, F.when(name.rlike(LICENCE_FILE), F.array(text)).otherwise(F.array()))


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, licence, word, tf): a few hundred rows, fixed with the templates."""
    named = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(templates)], "template int, licence string, body string")
    each = named.select("template", "licence", F.explode(_words(F.col("body"))).alias("word"))
    return each.groupBy("template", "licence", "word").agg(F.count("*").alias("tf"))


def own_licences(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key, licence, score) for the rows of files (key, name, text) that state a licence; key identifies a row."""
    spark = files.sparkSession
    terms = template_table(spark, templates)
    listed = terms.collect()
    vocabulary = sorted({r["word"] for r in listed})
    n = files.count()
    frequencies = files.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    frequencies = written(frequencies, "frequencies")
    counted = {r["word"]: r["df"] for r in frequencies.where(F.col("word").isin(vocabulary)).collect()}
    weights = spark.createDataFrame([(w, counted.get(w, 0)) for w in vocabulary], "word string, df long")
    weights = weights.select("word", _weight(n, F.col("df")).alias("w"))
    anchors = F.array(*[F.lit(w) for w in anchor_words(listed, counted, n, threshold)])
    likely = files.where(F.arrays_overlap(_words(F.col("text")), anchors))
    piece = likely.select("key", F.posexplode(pieces_of(F.col("name"), F.col("text"))).alias("piece", "body")).withColumn("words", _words(F.col("body")))
    piece = piece.where(F.arrays_overlap("words", anchors))
    piece = piece.select("key", F.lit(-1).alias("of"), F.col("piece").cast("long").alias("piece"), "words")  # of every template
    piece = piece.unionByName(windows(likely.select("key", "text"), templates, template_squares(listed, counted, n), counted, threshold))
    tf = piece.select("key", "of", "piece", F.explode("words").alias("word")).groupBy("key", "of", "piece", "word").agg(F.count("*").alias("tf"))
    weighed = tf.join(frequencies, "word").withColumn("x", F.col("tf") * _weight(n, F.col("df")))
    weighed = written(weighed.select("key", "of", "piece", "word", "x"), "pieces")
    norm = weighed.groupBy("key", "of", "piece").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    template = terms.join(weights, "word").select("template", "licence", "word", (F.col("tf") * F.col("w")).alias("y"))
    length = template.groupBy("template").agg(F.sqrt(F.sum(F.col("y") * F.col("y"))).alias("length"))
    template = F.broadcast(template.join(length, "template").select("template", "licence", "word", (F.col("y") / F.col("length")).alias("y")))
    met = weighed.join(template, "word").where("of = -1 OR of = template")
    dot = met.groupBy("key", "of", "piece", "template", "licence").agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    score = F.round(F.col("dot") / F.col("norm"), 6).alias("score")
    scored = dot.join(norm, ["key", "of", "piece"]).select("key", "licence", score).where(F.col("score") >= threshold)
    scored = scored.unionByName(tagged(files, templates))
    best = scored.groupBy("key").agg(F.max(F.struct("score", "licence")).alias("best"))
    return best.select("key", F.col("best.licence").alias("licence"), F.col("best.score").alias("score"))


def directory_of(path: Column) -> Column:
    """Path of the directory above, '' at the top."""
    return F.regexp_replace(F.regexp_replace(path, "/+$", ""), "/?[^/]*$", "")


def inherited(files: DataFrame, own: DataFrame) -> DataFrame:
    """files (key, path, name) with licence, score, basis (own, inherited, none) and from_path.

    Licence files alone give their licence to a directory and what is below it.  The nearest ancestor is found once for every directory, not for every file.
    """
    rows = files.join(own, "key", "left").withColumn("dir", directory_of(F.col("path")))
    rows = written(rows, "licensed")
    rank = F.struct("path", "licence")
    leads = written(rows.where(F.col("licence").isNotNull() & F.col("name").rlike(LICENCE_FILE)).groupBy("dir").agg(F.min(rank).alias("lead")), "leads")
    leads = leads.select(F.col("dir").alias("above"), F.col("lead.licence").alias("given"), F.col("lead.path").alias("given_by"))
    steps = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    dirs = rows.where("licence IS NULL").select("dir").distinct()
    up = dirs.select("dir", F.explode(F.array_distinct(ancestors)).alias("above"))
    found = up.join(leads, "above").withColumn("depth", F.when(F.col("above") == "", 0).otherwise(F.size(F.split("above", "/"))))
    nearest = found.groupBy(F.col("dir").alias("_dir")).agg(F.max(F.struct("depth", "given", "given_by")).alias("near"))
    nearest = written(nearest, "nearest")
    met = rows.join(nearest, F.col("licence").isNull() & (rows["dir"] == nearest["_dir"]), "left")
    basis = F.when(F.col("licence").isNotNull(), "own").when(F.col("near").isNotNull(), "inherited").otherwise("none")
    return met.select(
        "key", "path", F.coalesce("licence", "near.given").alias("licence"), "score", basis.alias("basis"),
        F.when(F.col("licence").isNotNull(), F.col("path")).otherwise(F.col("near.given_by")).alias("from_path"),
    )


def scan_licences(files: DataFrame, key: str, path: str, text: str, **options) -> DataFrame:
    """key, path, licence, score, basis, from_path for every row of files.

    key must tell files apart: rows of one key are one file, whose pieces are counted together and whose rows share the
    best licence.  Null texts state nothing, a null path counts as '' (the top), a null key inherits only; an empty table
    gives no rows; other columns are ignored.  Equal scores go to the licence last by name.
    """
    place = F.coalesce(F.col(path).cast("string"), F.lit(""))
    named = files.select(
        F.col(key).alias("key"), place.alias("path"), F.regexp_extract(place, "([^/]*)$", 1).alias("name"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    return inherited(named.drop("text"), own_licences(named.where("key IS NOT NULL").select("key", "name", "text"), **options))


def scan_documents(docs: DataFrame) -> DataFrame:
    """The scan over a documents table, which has no paths: the digits of doc_id are directories below source/lang.

    A document whose last digit is 0 is the file LICENSE of its directory, another one the file of its last digit: 120 is
    source/lang/1/2/LICENSE and licenses 12, 123 and 1205, which state nothing themselves.
    """
    digits = F.split(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "")
    name = F.when(F.col("doc_id") % 10 == 0, F.lit("LICENSE")).otherwise(F.element_at(digits, -1))
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.array_join(F.slice(digits, 1, F.size(digits) - 1), "/"), name)
    rows = docs.select("doc_id", F.regexp_replace(path, "/+", "/").alias("path"), "text")
    found = scan_licences(rows, "doc_id", "path", "text")
    return found.withColumnRenamed("key", "doc_id")
