"""Ingest once as a stream of file versions, for sources that replace files at their path."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.frames import small_frame
from tideline.sources.files import LINEAGE, list_files, with_lineage

VERSIONS = "path string, modified_us bigint, length bigint"
STREAM_BATCH = "_stream_batch"


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def note_versions(spark: SparkSession, source_dir: str, versions_dir: str, glob: str = "*.parquet") -> int:
    """Append the file versions below `source_dir` not noted before; how many.

    A version is a path, a modification time and a length.  Versions of one call are one file, so they are noted together.
    """
    listing = list_files(spark, source_dir, glob).select("path", F.unix_micros("modified_at").alias("modified_us"), "length")
    if _exists(spark, versions_dir):
        noted = spark.read.schema(VERSIONS).option("recursiveFileLookup", "true").parquet(versions_dir)
        listing = listing.join(noted, ["path", "modified_us", "length"], "left_anti")
    fresh = small_frame(spark, listing.collect(), VERSIONS)  # names of new files, as any scan of them lists
    n = fresh.count()
    if n:
        fresh.coalesce(1).write.parquet(f"{versions_dir}/{uuid.uuid4().hex}")
    return n


def stream_versions(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    state_dir: str,
    schema: T.StructType,
    partition_by: Sequence[str] = ("period",),
    loaded_at: datetime | None = None,
    actor: str | None = None,
) -> int:
    """Load the file versions that appeared since the last call, then stop; the number noted in this call.

    The stream's source is the list of versions, so what its checkpoint has seen is a version, and a file replaced
    at its path is read again.  Each micro-batch writes its own folder, whole: one repeated after a failure
    replaces what it had begun, so every version's rows are there once.  A file that was replaced again before
    its version was read has no rows under the older version; the newer one brings them.
    """
    versions_dir = f"{state_dir}/versions"
    noted = note_versions(spark, source_dir, versions_dir)
    if not _exists(spark, versions_dir):
        return noted

    def load(batch: DataFrame, number: int) -> None:
        wanted = batch.collect()  # names of the batch's files
        if not wanted:
            return
        here = {(r.path, r.modified_us, r.length) for r in _current(spark, source_dir, sorted({w.path for w in wanted})).collect()}
        paths = sorted({w.path for w in wanted if tuple(w) in here})
        if not paths:
            return
        rows = with_lineage(spark.read.schema(schema).option("basePath", source_dir).parquet(*paths), loaded_at, actor)
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{target_dir}/{STREAM_BATCH}={number:012d}")

    stream = spark.readStream.schema(VERSIONS).option("recursiveFileLookup", "true").parquet(versions_dir)
    query = (
        stream.writeStream.foreachBatch(load).option("checkpointLocation", f"{state_dir}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return noted


def _current(spark: SparkSession, source_dir: str, paths: list[str]) -> DataFrame:
    """The versions that the named files have now."""
    listing = list_files(spark, source_dir, "*.parquet").select("path", F.unix_micros("modified_at").alias("modified_us"), "length")
    return listing.join(small_frame(spark, [(p,) for p in paths], "path string"), "path", "left_semi").select("path", "modified_us", "length")


def all_versions(spark: SparkSession, target_dir: str, schema: T.StructType) -> DataFrame:
    """Rows of every version loaded, with the batch that brought them."""
    return spark.read.schema(T.StructType([*schema, *LINEAGE, T.StructField(STREAM_BATCH, T.StringType())])).parquet(target_dir)


def newest_versions(spark: SparkSession, target_dir: str, schema: T.StructType) -> DataFrame:
    """Rows of the newest loaded version of each path: the last modified one, of equal ones that of the last batch."""
    rows = all_versions(spark, target_dir, schema)
    newest = rows.groupBy("_loaded_from").agg(F.max(F.struct("_source_modified_at", STREAM_BATCH)).alias("v")).select(
        "_loaded_from", "v._source_modified_at", f"v.{STREAM_BATCH}"
    )
    return rows.join(newest, ["_loaded_from", "_source_modified_at", STREAM_BATCH], "left_semi").select(*rows.columns)
