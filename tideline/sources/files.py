"""Listing and scanning files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import instant

LINEAGE = (
    T.StructField("_loaded_from", T.StringType()),
    T.StructField("_loaded_at", T.TimestampType()),
    T.StructField("_loaded_by", T.StringType()),
    T.StructField("_source_modified_at", T.TimestampType()),
)


def list_files(spark: SparkSession, path: str, glob: str = "*", modified_after: str | None = None) -> DataFrame:
    """path, modified_at and length of every file below `path`; no content is read.

    `modified_after` (`yyyy-MM-ddTHH:mm:ss`) skips older files while listing.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(path).select("path", F.col("modificationTime").alias("modified_at"), "length")


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All files below `path`; columns named by directories (`period=...`) are included.

    Without a schema the footers are merged, so a column that only some files have is
    NULL elsewhere.  See `drift.read_evolving` for files whose types differ.
    """
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    return reader.parquet(path)


def with_lineage(df: DataFrame, loaded_at: datetime | None = None, actor: str | None = None) -> DataFrame:
    """Where each row came from, when and by whom it was loaded.  `df` must be a file scan."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_loaded_from"),
        (instant(loaded_at) if loaded_at else F.current_timestamp()).alias("_loaded_at"),
        (F.lit(actor) if actor else F.current_user()).alias("_loaded_by"),
        F.col("_metadata.file_modification_time").alias("_source_modified_at"),
    )


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """CSV with a declared schema: one blank or odd value must not retype a key column."""
    return spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(path)


def size_mismatches(files: DataFrame, expected: DataFrame, key: str = "path") -> DataFrame:
    """Files whose length is not the expected one.  An unknown or zero length is not checked."""
    wanted = expected.select(key, F.col("length").alias("expected_length"))
    known = F.col("expected_length").isNotNull() & (F.col("expected_length") != 0)
    return files.join(wanted, key).where(known & (F.col("expected_length") != F.col("length")))


def absent_files(files: DataFrame, expected: DataFrame, key: str = "path") -> DataFrame:
    """Expected files that never arrived."""
    return expected.join(files, key, "left_anti")


def check_sizes(files: DataFrame, expected: DataFrame, key: str = "path") -> DataFrame:
    """Pass `files` on, or fail when a transfer was cut short or never came."""
    absent = [r[key] for r in absent_files(files, expected, key).limit(5).collect()]
    if absent:
        raise ValueError(f"expected files are absent: {absent}")
    wrong = size_mismatches(files, expected, key).limit(5).collect()
    if wrong:
        details = ", ".join(f"{r[key]}: expected {r['expected_length']}, got {r['length']}" for r in wrong)
        raise ValueError(f"size mismatch: {details}")
    return files
