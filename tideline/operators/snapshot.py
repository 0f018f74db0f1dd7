"""Published names that point to immutable snapshots, switched in one statement.

A published name is a view over a snapshot: an external table over staged folders, with its own columns and
partitions.  New contents are staged, get a snapshot of their own and a manifest, and the view is replaced: one
catalog statement, whatever the number of partitions and whether or not the columns changed.
Readers that began before keep the old snapshot, later ones see the new one, none sees a mixture.

The manifest lists the partitions of a snapshot with their folders and mergeable statistics: rows, greatest
values and NULLs, per value of a column such as the feed.  It is written by the step that publishes, from
the files just written; what depends on these numbers alone reads no row.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.versions import (
    Staged, create_table, delete_folder, get_property, new_version, partition_name, point_partitions_to, quoted,
    require_no_nulls, split_name, stage, staged_partitions, versions_folder,
)

SNAPSHOT, VERSION, KEPT = "tideline.snapshot", "tideline.version", "tideline.statistics"
MANIFEST = "partition string, path string, grp string, row_count bigint, maxima map<string,string>, nulls map<string,bigint>"


@dataclass(frozen=True)
class Statistics:
    """What a manifest keeps per partition, and per value of `by` in it: rows, maxima and NULLs of columns."""

    by: str | None = None
    maxima: tuple[str, ...] = ()
    nulls: tuple[str, ...] = ()


def is_snapshot(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and get_property(spark, name, SNAPSHOT) is not None


def resolve(spark: SparkSession, name: str) -> str:
    """The table that holds the rows of a name: its snapshot, or itself."""
    return (get_property(spark, name, SNAPSHOT) if spark.catalog.tableExists(name) else None) or name


def kept_statistics(spark: SparkSession, name: str) -> Statistics:
    held = json.loads(get_property(spark, name, KEPT) or "{}")
    return Statistics(held.get("by"), tuple(held.get("maxima", ())), tuple(held.get("nulls", ())))


def manifest(spark: SparkSession, name: str) -> DataFrame:
    """Partitions and statistics of the snapshot that a name points to now."""
    version = get_property(spark, name, VERSION)
    if version is None:
        raise ValueError(f"{name} is no published snapshot")
    return spark.read.schema(MANIFEST).parquet(f"{version}/manifest")


def _measured(rows: DataFrame, path: str, partition_by: Sequence[str], kept: Statistics) -> DataFrame:
    """Manifest rows of staged files: a pass over the columns that are kept, of these files only."""

    def entries(columns: Sequence[str], value: Callable[[str], Column], kind: str) -> Column:
        pairs = [x for c in columns for x in (F.lit(c), value(c))]
        return (F.create_map(*pairs) if pairs else F.create_map()).cast(kind)

    named = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in partition_by]
    partition = F.concat_ws("/", *named) if named else F.lit("")
    group = F.col(kept.by).cast("string") if kept.by else F.lit(None).cast("string")
    folder = F.concat(F.lit(f"{path}/"), F.col("partition")) if named else F.lit(path)
    measured = rows.groupBy(partition.alias("partition"), group.alias("grp")).agg(
        F.count(F.lit(1)).alias("row_count"),
        entries(kept.maxima, lambda c: F.max(c).cast("string"), "map<string,string>").alias("maxima"),
        entries(kept.nulls, lambda c: F.count_if(F.col(c).isNull()), "map<string,bigint>").alias("nulls"),
    )
    return measured.select("partition", folder.alias("path"), "grp", "row_count", "maxima", "nulls")


def _switch(
    spark: SparkSession, name: str, version: str, schema: T.StructType, partition_by: Sequence[str], rows: DataFrame, kept: Statistics
) -> None:
    """Write the manifest, make the snapshot, and point the name to it: the last statement publishes."""
    rows.coalesce(1).write.parquet(f"{version}/manifest")
    database, short = split_name(name)
    held = f"{database}.{short}__{version.rsplit('/', 1)[1].replace('-', '_').lower()}"
    places = {r.partition: r.path for r in manifest_places(spark, version)}
    create_table(spark, held, schema, partition_by, f"{version}/rows" if not partition_by else f"{version}/none")
    if partition_by:
        by_root: dict[str, list[str]] = {}
        for partition, path in places.items():
            by_root.setdefault(path[: -len(partition) - 1], []).append(partition)
        for root, partitions in sorted(by_root.items()):
            point_partitions_to(spark, held, root, sorted(partitions))
    properties = _own_tags(spark, name) | {SNAPSHOT: held, VERSION: version, KEPT: json.dumps(asdict(kept))}
    listed = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({listed}) AS SELECT * FROM {held}")


def _own_tags(spark: SparkSession, name: str) -> dict[str, str]:
    """Tags of a name outlive its snapshots."""
    if not spark.catalog.tableExists(name):
        return {}
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return {k: v for k, v in held.items() if not k.startswith(("view.", "tideline.")) and k != "transient_lastDdlTime"}


def manifest_places(spark: SparkSession, version: str) -> list:
    """(partition, path) of a manifest, a row per partition."""
    return spark.read.schema(MANIFEST).parquet(f"{version}/manifest").select("partition", "path").distinct().collect()


def publish(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    partition_by: Sequence[str] = (),
    not_null: Iterable[str] = (),
    verify: Callable[[DataFrame], None] | None = None,
    spread: bool = True,
    statistics: Statistics | None = None,
) -> Staged:
    """Give a name new contents as a whole, of whatever columns; creates it when it is absent.

    A NULL in a `not_null` column and a failing `verify` (which gets the rows as written) leave the name as it was.
    Statistics are kept as before unless given.  A table of this name, made before, is replaced by
    a view: its files stay for readers that have begun, and for an instant the name is absent.
    """
    partition_by = list(partition_by)
    exists = spark.catalog.tableExists(name)
    kept = statistics or (kept_statistics(spark, name) if exists else Statistics())
    version = new_version(spark, name)
    staged = stage(df, f"{version}/rows", partition_by, not_null, spread)
    require_no_nulls(staged, name)
    written = spark.read.schema(df.schema).parquet(staged.path)
    if verify:
        verify(written)
    for partition in staged_partitions(spark, staged.path, df.schema, partition_by) if partition_by else []:
        partition_name(dict(p.split("=", 1) for p in partition.split("/")))
    if exists and not is_snapshot(spark, name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}/none'")  # so that DROP deletes no file in use
        spark.sql(f"DROP TABLE {name}")
    _switch(spark, name, version, df.schema, partition_by, _measured(written, staged.path, partition_by, kept), kept)
    return staged


def publish_partitions(
    spark: SparkSession, name: str, version: str, partition_by: Sequence[str], present: Sequence[str], emptied: Sequence[str] = ()
) -> None:
    """Replace some partitions by those staged under `version`, all at once; the others stay where they are."""
    kept = kept_statistics(spark, name)
    schema = spark.table(name).schema
    written = spark.read.schema(schema).parquet(f"{version}/rows")
    gone = [*present, *emptied]
    rest = manifest(spark, name).where(~F.col("partition").isin(gone)) if gone else manifest(spark, name)
    _switch(spark, name, version, schema, partition_by, rest.unionByName(_measured(written, f"{version}/rows", partition_by, kept)), kept)


def rows_per_partition(spark: SparkSession, name: str, column: str) -> DataFrame:
    """(column, row_count) from the manifest."""
    value = F.regexp_extract("partition", f"(?:^|/){column}=([^/]*)", 1)
    return manifest(spark, name).groupBy(value.alias(column)).agg(F.sum("row_count").alias("row_count"))


def stored_marks(spark: SparkSession, name: str, column: str) -> dict[str, str]:
    """Greatest value of a partition column per group of the statistics, from the manifest."""
    value = F.regexp_extract("partition", f"(?:^|/){column}=([^/]*)", 1)
    found = manifest(spark, name).where("row_count > 0 AND grp IS NOT NULL").groupBy("grp").agg(F.max(value).alias("mark"))
    return {r.grp: r.mark for r in found.collect()}


def stored_maximum(spark: SparkSession, name: str, column: str):
    """Greatest value of a column whose maxima are kept, in its own type; None without rows."""
    kind = spark.table(name).schema[column].dataType
    return manifest(spark, name).agg(F.max(F.col("maxima")[column].cast(kind))).first()[0]


def stored_nulls(spark: SparkSession, name: str, column: str) -> int:
    """NULLs of a column whose counts are kept."""
    return manifest(spark, name).agg(F.coalesce(F.sum(F.col("nulls")[column]), F.lit(0))).first()[0]


def expire_snapshots(spark: SparkSession, name: str, retain_days: int, now=None) -> list[str]:
    """Delete versions that no current manifest names, once they were unused for `retain_days`, with their snapshots.

    What is in use is read from the manifest: no file is listed."""
    from tideline.operators.maintain import expire_unused

    root = versions_folder(spark, name)
    used = {get_property(spark, name, VERSION).rsplit("/", 1)[1]}
    for r in manifest(spark, name).select("path").distinct().collect():
        used.add(r.path.split(f"{root}/", 1)[1].split("/", 1)[0] if f"{root}/" in r.path else r.path)
    expired = expire_unused(spark, name, used, retain_days, now)
    database, short = split_name(name)
    for version in expired:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{short}__{version.replace('-', '_').lower()}")
    return expired
