"""Small reference files: validation before anything else, change by content, seeds."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.sources.files import scan_csv

MIN_ROWS = 200  # fixed value: below this a reference file is suspect


class InvalidReference(ValueError):
    """A reference file is empty, has another header, or is too short to be whole."""


def validate_reference(spark: SparkSession, path: str, header: Sequence[str], min_rows: int = MIN_ROWS) -> int:
    """Row count of a header CSV, after checking it.

    Runs before the content hash is compared: a truncated file whose hash were recorded
    would look unchanged for ever after.  A leading byte order mark is not part of the
    first name, and blanks around names do not count.
    """
    raw = spark.read.option("header", True).csv(path)
    names = [c.lstrip("﻿").strip() for c in raw.columns]
    if not names:
        raise InvalidReference(f"{path} is empty")
    if names != list(header):
        raise InvalidReference(f"header {names}, expected {list(header)}")
    rows = raw.count()
    if rows < min_rows:
        raise InvalidReference(f"{rows} rows, expected at least {min_rows}")
    return rows


def content_hashes(spark: SparkSession, path: str) -> DataFrame:
    """sha256 of the bytes of each file, hashed where the file is read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def content_changed(hashes: DataFrame, ledger: DataFrame) -> DataFrame:
    """`hashes` with `prior_sha256` and `changed` against the last landed hash of each path."""
    last = ledger.groupBy("path").agg(F.max_by("sha256", "landed_at").alias("prior_sha256"))
    return hashes.join(last, "path", "left").withColumn(
        "changed", ~F.col("prior_sha256").eqNullSafe(F.col("sha256"))
    )


def archive_copy(df: DataFrame, folder: str, name: str, at: datetime | None = None) -> str:
    """Write a dated copy, then the current one; returns the folder of the dated copy.

    The dated copy comes first, so a bad change of the current one can be undone.
    """
    stamp = (at or datetime.now(timezone.utc)).strftime("%Y%m%d%H%M%S")
    history = f"{folder}/history/{name}_{stamp}"
    df.write.option("header", True).csv(history)
    df.write.mode("overwrite").option("header", True).csv(f"{folder}/current/{name}")
    return history


def load_seed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A code list with a typed key.  Reload it whole, so that removed codes vanish."""
    return scan_csv(spark, path, schema)
