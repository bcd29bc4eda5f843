"""Sinks: partitioned logs, archives, atomically replaced documents and paged feeds."""

from __future__ import annotations

import json
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.time import parse_instant


def append_log(rows: DataFrame, path: str, timestamp: str = "timestamp") -> None:
    """Append records as JSON lines under y/m/d partitions of their UTC day; keys in alphabetical order."""
    at = parse_instant(F.col(timestamp))
    ordered = rows.select(*sorted(rows.columns), F.date_format(at, "yyyy").alias("y"), F.date_format(at, "MM").alias("m"), F.date_format(at, "dd").alias("d"))
    ordered.write.partitionBy("y", "m", "d").mode("append").json(path)


def write_archive(rows: DataFrame, path: str) -> None:
    """Parquet with ZSTD, nested values kept as they are."""
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def _shared(path: str):
    """The Hadoop file system of an address with a scheme and its path class; None for a plain local path."""
    if "://" not in path or path.startswith("file://"):
        return None
    spark = SparkSession.getActiveSession()
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def replace_document(path: str, document: object) -> None:
    """Replace a small JSON document at once: readers see the old or the new one; a failure leaves the old. Addresses of
    a shared file system are written beside their place and renamed there."""
    shared = _shared(path)
    if shared:
        fs, make = shared
        text = json.dumps(document, sort_keys=True, default=str)
        temporary = make(f"{path}.new")
        out = fs.create(temporary, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        fs.delete(make(path), False)
        if not fs.rename(temporary, make(path)):
            raise OSError(f"{path} can't be replaced")
        return
    target = Path(path.removeprefix("file://"))
    target.parent.mkdir(parents=True, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=target.parent, prefix=f".{target.name}.")
    try:
        with os.fdopen(handle, "w") as f:
            json.dump(document, f, sort_keys=True, default=str)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temporary, target)
    except BaseException:
        Path(temporary).unlink(missing_ok=True)
        raise


def write_feed(pages: DataFrame, path: str, page: str = "page") -> dict[str, object]:
    """Write rows with a page number as one folder of JSON lines per page and a manifest; stale pages go. The feed is
    staged beside its place and swapped in, so readers see one version."""
    path = path.rstrip("/")
    staged, old = f"{path}.staged", f"{path}.old"
    pages.repartition(F.col(page)).write.mode("overwrite").partitionBy(page).json(staged)
    counts = pages.groupBy(page).agg(F.count(F.lit(1)).alias("items")).agg(F.count(F.lit(1)).alias("pages"), F.sum("items").alias("items")).first()
    manifest = {"pages": counts["pages"], "items": counts["items"] or 0}
    replace_document(f"{staged}/manifest.json", manifest)
    shared = _shared(path)
    if shared:
        fs, make = shared
        fs.delete(make(old), True)
        if fs.exists(make(path)) and not fs.rename(make(path), make(old)):
            raise OSError(f"{path} can't be replaced")
        if not fs.rename(make(staged), make(path)):
            raise OSError(f"{path} can't be replaced")
        fs.delete(make(old), True)
        return manifest
    path, staged, old = (x.removeprefix("file://") for x in (path, staged, old))
    if os.path.exists(path):
        os.replace(path, old)
    os.replace(staged, path)
    shutil.rmtree(old, ignore_errors=True)
    return manifest


def as_text_columns(rows: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for sinks that hold flat columns only."""
    nested = [c for c, kind in rows.dtypes if kind.startswith(("array", "map", "struct"))]
    return rows.withColumns({c: F.to_json(c) for c in nested})
