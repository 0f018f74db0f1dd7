"""Batches of a raw table written together, so that many small loads end in few files.

A load has its own partitions (`period`, batch), which makes it invisible until it is complete and costs a file per
period for ever.  A fold rewrites small partitions of a period as one, whose batch is the fold; each row keeps
the batch that brought it in a column.  One ledger row per partition, all in one file, completes the
fold: from then on readers see its partitions and no longer those it replaced, which are
dropped later, when no reader can be using them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tideline.frames import small_frame
from tideline.operators.ingest import (
    BATCH, ORIGIN, decoded, drop_unfinished, folds_table, origin, partition_column, partition_statistics, stored_partitions,
)
from tideline.operators.maintain import RETAIN_DAYS, TARGET_BYTES, clustered
from tideline.operators.versions import drop_partitions, partition_columns
from tideline.sources.files import list_files


def partition_sizes(spark: SparkSession, table: str) -> DataFrame:
    """(partition, _batch_id, files, bytes) of the live partitions, from a listing of the table's folder by tasks."""
    place = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first().data_type
    inner = F.regexp_extract("path", f"/((?:[^/=]+=[^/]*/)*){BATCH}=[^/]*/[^/]*$", 1)
    files = list_files(spark, place, "*.parquet").select(
        decoded(F.regexp_replace(inner, "/$", "")).alias("partition"), F.regexp_extract("path", f"/{BATCH}=([^/]*)/", 1).alias(BATCH), "length"
    )
    sizes = files.groupBy("partition", BATCH).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    live = stored_partitions(spark, table).where("state = 'live'").select("partition", BATCH)
    return live.join(sizes, ["partition", BATCH])


def fold_batches(spark: SparkSession, table: str, cluster_by: str | None = None, target_bytes: int = TARGET_BYTES) -> int:
    """Fold what is small; returns the number of partitions written.

    In each period the live partitions below `target_bytes` are written together if they are several, or one of
    several files that are small on average.  A period takes one task, or, where the small ones together exceed the
    target, about one for each `target_bytes`, cut by ranges of `cluster_by` and a row hash.  A second run does nothing.
    Rows are compared with the load's statistics before the fold is completed; one that stops earlier is dropped by
    the next load or fold.  `committed`, `latest_files` and `reset` see the same rows before, between and after.
    One load or fold per table at a time.
    """
    drop_unfinished(spark, table)
    small = partition_sizes(spark, table).where(F.col("bytes") < target_bytes)
    due = small.groupBy("partition").agg(
        F.collect_list(BATCH).alias("replaced"), F.sum("files").alias("files"), F.sum("bytes").alias("bytes")
    )
    crowded = (F.size("replaced") > 1) | ((F.col("files") > 1) & (F.col("bytes") * 4 < F.col("files") * target_bytes))
    chosen = due.where(crowded).collect()  # one row per period that is due
    if not chosen:
        return 0
    if ORIGIN not in spark.table(table).columns:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({ORIGIN} string)")
    fold_id, watch = f"fold-{uuid.uuid4().hex}", Observation()
    single = [r for r in chosen if round(r.bytes / target_bytes) <= 1]
    several = [r for r in chosen if round(r.bytes / target_bytes) > 1]
    keys = [c for c in partition_columns(spark, table) if c != BATCH]
    parts = []
    if single:
        tasks = min(len(single), max(8, 2 * -(-sum(r.bytes for r in single) // target_bytes)))
        order = list(dict.fromkeys([*keys, *([cluster_by] if cluster_by else [])]))
        rows = _rows(spark, table, keys, single).repartition(tasks, *keys) if keys else _rows(spark, table, keys, single).coalesce(1)
        parts.append(rows.sortWithinPartitions(*order) if order else rows)
    if several:
        tasks = -(-sum(r.bytes for r in several) // target_bytes)
        column = cluster_by or (keys or ["_loaded_from"])[0]
        parts.append(clustered(_rows(spark, table, keys, several), column, tasks, keys))
    rows = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    rows = rows.withColumns({ORIGIN: origin(rows), BATCH: F.lit(fold_id)}).select(*spark.table(table).columns)
    rows.observe(watch, F.count(F.lit(1)).alias("rows")).write.insertInto(table)
    known = _known_rows(spark, table)
    taken = small_frame(spark, [(r.partition, b) for r in chosen for b in r.replaced], f"partition string, {BATCH} string")
    replaced = taken.join(known, ["partition", BATCH], "left")
    counts = replaced.groupBy("partition").agg(
        F.collect_list(BATCH).alias("replaced"), F.sum("row_count").alias("row_count"), F.count_if(F.col("row_count").isNull()).alias("unknown")
    )
    before = counts.agg(F.sum("row_count"), F.sum("unknown")).first()
    if before[1] or before[0] != watch.get["rows"]:
        raise RuntimeError(f"{table}: {before[0]} rows became {watch.get['rows']} in a fold ({before[1]} partitions without statistics)")
    done = counts.select("partition", "replaced", "row_count", F.current_timestamp().alias("committed_at"), F.lit(fold_id).alias(BATCH))
    done.coalesce(1).write.insertInto(folds_table(table))
    return len(chosen)


def _rows(spark: SparkSession, table: str, keys: Sequence[str], due: list) -> DataFrame:
    """Rows of the partitions to be replaced; the batches are literals, so the scan lists no others."""
    raw = spark.table(table)
    ids = sorted({b for r in due for b in r.replaced})
    pairs = small_frame(spark, [(r.partition, b) for r in due for b in r.replaced], "__partition string, __batch string")
    rows = raw.where(F.col(BATCH).isin(ids))
    return rows.join(pairs, (F.col(BATCH) == F.col("__batch")) & (partition_column(keys) == F.col("__partition")), "left_semi")


def _known_rows(spark: SparkSession, table: str) -> DataFrame:
    """Rows of each partition by load statistics, and of each fold by the sum of what it replaced."""
    loaded = partition_statistics(spark, table).select("partition", BATCH, "row_count")
    return loaded.union(spark.table(folds_table(table)).select("partition", BATCH, "row_count"))


def expire_folded(spark: SparkSession, table: str, retain_days: int = RETAIN_DAYS, now: datetime | None = None) -> int:
    """Drop partitions that a fold replaced at least `retain_days` ago; the number dropped."""
    limit = (now or datetime.now(timezone.utc)) - timedelta(days=retain_days)
    old = spark.table(folds_table(table)).where(F.col("committed_at") <= F.lit(limit))
    gone = old.select("partition", F.explode("replaced").alias(BATCH))
    folded = stored_partitions(spark, table).where("state = 'folded'")
    names = [r.name for r in folded.join(gone, ["partition", BATCH], "left_semi").collect()]
    drop_partitions(spark, table, names)
    return len(names)
