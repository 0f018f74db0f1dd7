"""Incremental tables with a unique key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.contract import SchemaMismatch, schema_differences
from tideline.operators.snapshot import Statistics, is_snapshot, publish, publish_partitions, resolve
from tideline.operators.versions import (
    delete_folder,
    finish_pending,
    new_version,
    partition_columns,
    partition_name,
    registered_partitions,
    replace_contents,
    require_no_nulls,
    stage,
    staged_partitions,
    switch_partitions,
)


class DuplicateKeys(ValueError):
    """The merge source has a key more than once."""


@dataclass(frozen=True)
class MergeResult:
    mode: str
    partitions_rewritten: int
    rows_written: int


def merge_frames(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is not in the source, and all source rows."""
    return target.join(source.select(key), key, "left_anti").select(*target.columns).unionByName(source)


def check_schema_unchanged(target: DataFrame, source: DataFrame) -> None:
    """Added, removed and retyped columns all stop the run; none is appended silently."""
    differences = schema_differences(source.schema, {f.name: f.dataType.simpleString() for f in target.schema})
    if differences:
        raise SchemaMismatch("; ".join(differences))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def dedupe_source(df: DataFrame, key: str, latest_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by `latest_by`, the other columns breaking ties.

    A maximum over a struct combines on the map side, so a key with very many copies
    costs no more than any other; a ranking window would sort them all in one task.
    """
    others = [c for c in df.columns if c != key and c not in latest_by]
    newest = df.groupBy(key).agg(F.max(F.struct(*latest_by, *others)).alias("row"))
    return newest.select(*[F.col(key) if c == key else F.col(f"row.{c}").alias(c) for c in df.columns])


def high_mark(spark: SparkSession, table: str, column: str, default: str = "1900-01") -> str:
    """Largest value of a column in a table; for a partition column from the catalog alone."""
    if not spark.catalog.tableExists(table):
        return default
    table = resolve(spark, table)
    finish_pending(spark, table)
    if column in partition_columns(spark, table):
        names = spark.sql(f"SHOW PARTITIONS {table}")
        values = names.select(F.regexp_extract("partition", f"(?:^|/){column}=([^/]*)", 1).alias(column))
    else:
        values = spark.table(table).select(column)
    return values.agg(F.coalesce(F.max(column), F.lit(default))).first()[0]


def high_marks(target: DataFrame, feed: str, column: str) -> dict[str, str]:
    """Largest value per feed; for feeds that do not keep pace with one another."""
    return {row[0]: row[1] for row in target.groupBy(feed).agg(F.max(column)).collect()}


def since(column: str, mark: str) -> Column:
    """Rows of the mark's period and later.  The mark is a literal, so scans prune on it."""
    return F.col(column) >= F.lit(mark)


def since_per_feed(feed: str, column: str, marks: dict[str, str]) -> Column:
    """As `since`, with a mark for each feed; feeds without one pass in full."""
    condition = ~F.col(feed).isin(list(marks)) if marks else F.lit(True)
    for name, mark in marks.items():
        condition = condition | ((F.col(feed) == name) & since(column, mark))
    return condition


def merge_into(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    key: str,
    partition_by: str,
    latest_by: Sequence[str] = (),
    not_null: Sequence[str] = (),
    full_refresh: bool = False,
    by_partition: bool = False,
    replaces: Sequence[str] = (),
    key_date: str | None = None,
    snapshot: bool = False,
    statistics: Statistics | None = None,
) -> MergeResult:
    """Replace matched keys, insert the others; running it twice equals running it once.

    An absent table, or `full_refresh`, is built whole.  Otherwise the key does not fix
    the partition, so a matched row may lie in any of them:

    1. the source is written once (it is needed four times, and an executor lost later
       must not recompute it); keys are checked to be unique, or with `latest_by` reduced;
    2. partitions holding a matched key are found from two columns of the target;
    3. only those and the source's own partitions are rewritten, beside the old ones;
    4. partitions are switched over, and those left empty dropped.

    `replaces` names partitions that the source restates as a whole: their rows go even where
    the source no longer has the key.

    `key_date` names a DATE column that the key fixes, such as one it is made of: a matched row has the
    source row's date, so step 2 asks only for the source's dates, by literal ranges that the scan holds
    against the statistics of files and row groups.  Without it the key of the whole target is read.
    Compact the target by this column to keep its ranges narrow.

    `snapshot` publishes through a name that points to a snapshot (see `snapshot`): all partitions change at once,
    a full refresh may bring other columns, and `statistics` are kept in the manifest.  A name that is one already
    stays one.

    `by_partition` tells that the source arrives laid out by `partition_by`, as a scan of
    such a table does: a whole build then writes it as it comes, without a shuffle.
    """
    if not spark.catalog.tableExists(table) or full_refresh:
        rows = dedupe_source(source, key, latest_by) if latest_by else source
        unique = None if latest_by else lambda written: _require_unique(written, key)
        if snapshot or is_snapshot(spark, table):
            staged = publish(spark, table, rows, [partition_by], not_null, unique, not by_partition, statistics)
        else:
            staged = replace_contents(spark, table, rows, [partition_by], not_null, unique, not by_partition)
        return MergeResult("full", len(registered_partitions(spark, resolve(spark, table))), staged.rows)

    pointed = is_snapshot(spark, table)
    if not pointed:
        finish_pending(spark, table)
    target = spark.table(table)
    check_schema_unchanged(target, source)
    version = new_version(spark, table)
    rows = dedupe_source(source, key, latest_by) if latest_by else source
    staged = stage(rows.select(*target.columns), new_version(spark, table), (), not_null)
    require_no_nulls(staged, table)
    fresh = spark.read.schema(target.schema).parquet(staged.path)
    if not latest_by:
        _require_unique(fresh, key)

    matched = matched_partitions(target, fresh, key, partition_by, key_date)
    affected = {r[0] for r in matched.union(fresh.select(partition_by)).distinct().collect()}
    held = {p.split("=", 1)[1] for p in registered_partitions(spark, resolve(spark, table))} if replaces else set()
    affected = sorted(affected | (held & set(replaces)))
    if not affected:
        delete_folder(spark, staged.path)
        return MergeResult("incremental", 0, 0)
    untouched = target.where(F.col(partition_by).isin([p for p in affected if p not in replaces]))
    merged = stage(merge_frames(untouched, fresh, key), f"{version}/rows", [partition_by])
    present = staged_partitions(spark, merged.path, target.schema, [partition_by])
    emptied = sorted({partition_name({partition_by: p}) for p in affected} - set(present))
    if pointed:
        publish_partitions(spark, table, version, [partition_by], present, emptied)
    else:
        switch_partitions(spark, table, version, present, emptied)
    delete_folder(spark, staged.path)
    return MergeResult("incremental", len(present), merged.rows)


def matched_partitions(
    target: DataFrame, fresh: DataFrame, key: str, partition_by: str, key_date: str | None = None
) -> DataFrame:
    """Partition values of the target rows whose key is in `fresh`."""
    if key_date:
        target = target.where(within_dates(key_date, fresh))
    return target.select(key, partition_by).join(fresh.select(key), key, "left_semi").select(partition_by)


def within_dates(column: str, rows: DataFrame, most: int = 24) -> Column:
    """`column` has a date that occurs in `rows`, or lies between two that do; NULL where `rows` has NULL.

    At most `most` ranges: the widest gaps between the dates stay gaps, so a few stray dates far
    off do not widen the rest.  The driver sees distinct dates only.
    """
    if rows.schema[column].dataType != T.DateType():
        raise ValueError(f"{column} is no DATE column")
    found = {r[0] for r in rows.select(column).distinct().collect()}
    days = sorted(found - {None})
    gaps = sorted(range(1, len(days)), key=lambda i: days[i - 1] - days[i])[: most - 1]
    starts = [0, *sorted(i for i in gaps if (days[i] - days[i - 1]).days > 1), len(days)]
    condition = F.col(column).isNull() if None in found else F.lit(False)
    for first, end in zip(starts, starts[1:]):
        if end > first:
            condition = condition | F.col(column).between(F.lit(days[first]), F.lit(days[end - 1]))
    return condition


def _require_unique(df: DataFrame, key: str) -> None:
    examples = duplicate_keys(df, key).limit(5).collect()
    if examples:
        raise DuplicateKeys(f"{key} is not unique in the source, e.g. {[r[0] for r in examples]}")
