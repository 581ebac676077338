"""Manifests of written databases: what they were made from and how, and whether they are still current.

A manifest and the reports that it covers are small; they are read and written by the driver through the file system
that their path names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

PARALOG_REPORT, SHARED_REPORT = "identical_paralogs.tsv", "shared_exon_genes.tsv"
FORMAT = 1
#: What a database folder must hold, and the columns that must be in its tables.
PARTS = {
    "exon_info": ["exon_id_full", "exon_id", "length", "left_anchor_length", "right_anchor_length", "anchored_length"],
    "exon_aliases": ["blast_exon_id_full", "exon_id", "left_anchor_length", "right_anchor_length", "anchored_length"],
}


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _file_system(spark, path)
    return fs.exists(place)


def identity(spark: SparkSession, path: str) -> dict:
    """Path, bytes and time of change of a file; its content is not read."""
    fs, place = _file_system(spark, path)
    status = fs.getFileStatus(place)
    return {"path": status.getPath().toString(), "size": status.getLen(), "modified": status.getModificationTime()}


def digest(spark: SparkSession, path: str) -> str:
    """SHA-256 of a small file."""
    return spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).first()[0]


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """value as JSON at `path`: written beside it and renamed, so that a reader sees the old file or the new one whole."""
    fs, place = _file_system(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(new, True)
    out.write(bytearray((json.dumps(value, indent=2, sort_keys=True) + "\n").encode()))
    out.close()
    if fs.exists(place):
        fs.delete(place, False)
    if not fs.rename(new, place):
        raise OSError(f"{path}: could not be renamed")


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads("".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def report_beside(spark: SparkSession, path: str, name: str = PARALOG_REPORT) -> str | None:
    """The report of that name in the folder of an exon table, if there is one."""
    beside = f"{path.rstrip('/').rpartition('/')[0] or '.'}/{name}"
    return beside if exists(spark, beside) else None


def write_manifest(spark: SparkSession, folder: str, reference: str, annotation: str, settings: dict) -> dict:
    """The manifest of a database folder: identities of what it was made from, its settings, digests of its reports."""
    reports = {name: digest(spark, f"{folder}/{name}") for name in (PARALOG_REPORT, SHARED_REPORT)}
    made = {"format": FORMAT, "reference": identity(spark, reference), "annotation": identity(spark, annotation), "settings": settings, "reports": reports}
    write_json(spark, f"{folder}/manifest.json", made)
    return made


def state_of(spark: SparkSession, folder: str, reference: str | None = None, annotation: str | None = None, settings: dict | None = None) -> str:
    """'' for a database folder that is whole and, as far as these are given, made from them; else what is the matter."""
    for name in (*PARTS, "exons.fa", "exons.seq", PARALOG_REPORT, SHARED_REPORT, "manifest.json"):
        if not exists(spark, f"{folder}/{name}"):
            return f"missing {name}"
    try:
        held = read_json(spark, f"{folder}/manifest.json")
    except ValueError:
        return "the manifest is no JSON"
    if not isinstance(held, dict) or held.get("format") != FORMAT:
        return "the manifest is of another format"
    for name in (PARALOG_REPORT, SHARED_REPORT):
        if held.get("reports", {}).get(name) != digest(spark, f"{folder}/{name}"):
            return f"{name} has changed"
    for name, needed in PARTS.items():
        rows = spark.read.csv(f"{folder}/{name}", sep="\t", header=True, inferSchema=False, quote="")
        missing = [c for c in needed if c not in rows.columns]
        if missing or rows.isEmpty():
            return f"{name} lacks {missing}" if missing else f"{name} is empty"
    first = spark.read.text(f"{folder}/exons.fa").where("startswith(value, '>')").first()
    if first is None or first[0].count("\t") < 9:
        return "exons.fa has no anchored records"
    given = {"reference": reference and identity(spark, reference), "annotation": annotation and identity(spark, annotation), "settings": settings}
    changed = [k for k, v in given.items() if v is not None and held.get(k) != v]
    return f"{', '.join(changed)} changed" if changed else ""
