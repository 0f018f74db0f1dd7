"""Upkeep of written tables: file sizes, layout, and folders no longer in use."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.frames import small_frame
from tideline.operators.versions import (
    NULL_FOLDER,
    PENDING,
    delete_folder,
    file_names,
    finish_pending,
    get_property,
    new_version,
    partition_columns,
    point_table_to,
    split_name,
    stage,
    staged_partitions,
    switch_partitions,
    versions_folder,
)

TARGET_BYTES = 256 * 1024 * 1024
RETAIN_DAYS = 7


def table_files(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each file of a table with its size and its values of `by` (partition columns).

    Names come from the planning of a scan, sizes from listings of the folders by tasks: the
    cost is that of the number of files, whatever they hold.
    """
    spark = df.sparkSession
    columns = [df.schema[c] for c in by]
    folders = sorted({name.rsplit("/", 1)[0] for name in file_names(df)})
    if not folders:
        nothing = T.StructType([*columns, T.StructField("path", T.StringType()), T.StructField("bytes", T.LongType())])
        return spark.createDataFrame([], nothing)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)

    def value(column: T.StructField) -> Column:
        text = F.regexp_extract("path", f"/{column.name}=([^/]*)/", 1)
        return F.when(text != NULL_FOLDER, F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))).cast(column.dataType)

    return listed.select(*[value(c).alias(c.name) for c in columns], "path", F.col("length").alias("bytes"))


def describe_detail(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of files and bytes, per value of `by` if given."""
    return table_files(df, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("size_in_bytes")
    )


def clustered(df: DataFrame, cluster_by: str, parts: int, within: Sequence[str] = ()) -> DataFrame:
    """Range-partition and sort by `cluster_by`, so file statistics are tight.

    A value that holds much of the table is cut further by a row hash: a range over the
    column alone would put all of it into one task.
    """
    keys = list(dict.fromkeys([*within, cluster_by]))
    spread = F.xxhash64(*[c for c in df.columns if c not in keys] or keys)
    return df.repartitionByRange(parts, *[F.col(k) for k in keys], spread).sortWithinPartitions(*keys)


def compact(spark: SparkSession, table: str, cluster_by: str, target_bytes: int = TARGET_BYTES) -> int:
    """Rewrite what consists of small files; returns the number of partitions rewritten.

    Small is a mean below a quarter of the target, in a partition of several files.  What is due
    one file goes to one task by its partition; larger partitions are cut by ranges of
    about the target, so that what was rewritten is not small again and a second run does nothing.
    Rows are counted before the table is switched; a difference leaves it as it was.
    """
    keys = partition_columns(spark, table)
    if keys:
        finish_pending(spark, table)
    df = spark.table(table)
    small = (F.col("num_files") > 1) & (F.col("size_in_bytes") * 4 < F.col("num_files") * target_bytes)
    named = F.lit(True)
    for k in keys:
        named = named & F.col(k).isNotNull()
    crowded = describe_detail(df, keys).where(small & named).collect()
    if not crowded:
        return 0
    version = new_version(spark, table)
    path = f"{version}/rows"
    if not keys:
        parts = max(1, round(crowded[0].size_in_bytes / target_bytes))
        written, before = stage(clustered(df, cluster_by, parts), path).rows, df.count()
    else:
        written = before = 0
        single = [r for r in crowded if round(r.size_in_bytes / target_bytes) <= 1]
        several = [r for r in crowded if round(r.size_in_bytes / target_bytes) > 1]
        for group in (single, several):
            if not group:
                continue
            rows = _of_partitions(df, keys, group)
            parts = -(-sum(r.size_in_bytes for r in group) // target_bytes)
            if group is single:
                parts = min(len(single), max(8, 2 * parts))
                order = list(dict.fromkeys([*keys, cluster_by]))
                laid_out = rows.repartition(parts, *keys).sortWithinPartitions(*order)
            else:
                laid_out = clustered(rows, cluster_by, parts, keys)
            written += stage(laid_out, path, keys, spread=False, mode="append").rows
            before += rows.count()
    if written != before:
        raise RuntimeError(f"{table}: {before} rows became {written} during compaction")
    if keys:
        switch_partitions(spark, table, version, staged_partitions(spark, path, df.schema, keys))
    else:
        point_table_to(spark, table, path)
    return len(crowded)


def _of_partitions(df: DataFrame, keys: Sequence[str], partitions: Sequence[Row]) -> DataFrame:
    """Rows of the listed partitions; none has a NULL value, which no statement could name."""
    chosen = small_frame(df.sparkSession, [tuple(r[k] for k in keys) for r in partitions], df.select(*keys).schema)
    return df.where(F.col(keys[0]).isin(sorted({r[keys[0]] for r in partitions}))).join(chosen, keys, "left_semi")


def _children(spark: SparkSession, path: str) -> list[str]:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return [status.getPath().getName() for status in system.listStatus(folder)]


def versions_in_use(spark: SparkSession, table: str) -> set[str]:
    """Version folders that hold a file of the table, or a publication not yet finished."""
    marker = f"/_versions/{split_name(table)[1]}/"
    names = file_names(spark.table(table))
    used = {name.split(marker, 1)[1].split("/", 1)[0] for name in names if marker in name}
    pending = get_property(spark, table, PENDING)
    return used | ({pending.rstrip("/").rsplit("/", 1)[1]} if pending else set())


def expire_versions(
    spark: SparkSession, table: str, retain_days: int = RETAIN_DAYS, now: datetime | None = None
) -> list[str]:
    """Delete version folders unused for `retain_days`; returns their names.

    A folder is noted when it is first found unused and deleted by a later run, once the
    note is old enough: what counts is how long nobody could start reading it, not its
    age.  Queries that run while a version is replaced keep their files.
    """
    return expire_unused(spark, table, versions_in_use(spark, table), retain_days, now)


def expire_unused(
    spark: SparkSession, table: str, used: set[str], retain_days: int = RETAIN_DAYS, now: datetime | None = None
) -> list[str]:
    """As `expire_versions`, given the versions in use."""
    now = now or datetime.now(timezone.utc)
    root = versions_folder(spark, table)
    notes = f"{root.rsplit('/', 1)[0]}/_unused/{split_name(table)[1]}"
    unused = sorted(set(_children(spark, root)) - used)
    schema = "version string, noted_at_s bigint"
    noted = {}
    if _children(spark, notes):
        rows = spark.read.schema(schema).parquet(notes).groupBy("version").agg(F.min("noted_at_s").alias("noted"))
        noted = {r.version: r.noted for r in rows.collect()}
    fresh = [(v, int(now.timestamp())) for v in unused if v not in noted]
    if fresh:
        small_frame(spark, fresh, schema).coalesce(1).write.mode("append").parquet(notes)
    limit = int((now - timedelta(days=retain_days)).timestamp())
    expired = [v for v in unused if v in noted and noted[v] <= limit]
    for version in expired:
        delete_folder(spark, f"{root}/{version}")
    return expired
