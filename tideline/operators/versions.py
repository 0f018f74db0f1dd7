"""Tables whose new contents are written beside the old ones and then switched to.

A rewrite goes to its own folder first.  Readers change over by a catalog statement per
partition (or one for a whole table), so nothing is copied, no file in use is touched
and a failed write leaves the table as it was.  `maintain.expire_versions` later removes
folders that no table points to.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.frames import small_frame
from tideline.session import shared_dir

PENDING = "tideline.pending"
_SAFE = re.compile(r"[A-Za-z0-9_. -]+")
_STATEMENT_SIZE = 200
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def create_database(spark: SparkSession, name: str, folder: str | None = None, comment: str = "") -> str:
    """Database whose tables live in `folder`, by default below the shared folder."""
    folder = folder or f"{shared_dir(spark)}/tideline/db/{name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT {quoted(comment)} LOCATION '{folder}'")
    return name


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def split_name(table: str) -> tuple[str, str]:
    database, _, name = table.rpartition(".")
    return database or "default", name


def versions_folder(spark: SparkSession, table: str) -> str:
    database, name = split_name(table)
    return f"{spark.catalog.getDatabase(database).locationUri}/_versions/{name}"


def new_version(spark: SparkSession, table: str) -> str:
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S")
    return f"{versions_folder(spark, table)}/{stamp}-{uuid.uuid4().hex[:8]}"


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def registered_partitions(spark: SparkSession, table: str) -> set[str]:
    """Partition names as the catalog has them, e.g. `period=2025-01`; names only."""
    return {row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}


@dataclass(frozen=True)
class Staged:
    path: str
    rows: int
    nulls: dict[str, int]


def stage(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), not_null: Iterable[str] = (), spread: bool = True,
    mode: str = "error",
) -> Staged:
    """Write `df` to `path`; row and NULL counts come from the same pass over the data.

    With `spread` the rows of a partition are brought together before the write.  The
    rebalance splits a partition that holds much of the data over several tasks and
    merges small ones, so files have an even size whatever the distribution.  Rows that
    arrive by partition already (a scan of files laid out so) need no such shuffle.

    Counts are taken after the shuffle, in the tasks that write: a shuffle task repeated
    for a lost executor would be counted twice.
    """
    not_null = list(not_null)
    if partition_by and spread:
        df = df.hint("rebalance", *partition_by)
    watch = Observation()
    counted = df.observe(
        watch,
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null],
    )
    counted.write.mode(mode).partitionBy(*partition_by).parquet(path)
    seen = watch.get
    return Staged(path, seen["rows"], {c: seen[f"null_{c}"] for c in not_null})


def staged_partitions(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str]) -> list[str]:
    """Names of the partitions under a staged folder, from the names of its files."""
    folders = {tuple(f.split("/")[-1 - len(columns) : -1]) for f in file_names(spark.read.schema(schema).parquet(path))}
    values = [dict(part.split("=", 1) for part in folder) for folder in sorted(folders)]
    return [partition_name({c: None if v[c] == NULL_FOLDER else v[c] for c in columns}) for v in values]


def file_names(df: DataFrame) -> list[str]:
    """Paths of the files a scan would read, as its planning lists them; no file is opened."""
    return [unquote(name) for name in df.inputFiles()]


def partition_name(values: dict[str, object]) -> str:
    for value in values.values():
        if value is None or not _SAFE.fullmatch(str(value)):
            raise ValueError(f"not usable as a partition value: {value!r}")
    return "/".join(f"{column}={value}" for column, value in values.items())


def _clause(partition: str) -> str:
    pairs = (part.split("=", 1) for part in partition.split("/"))
    return "PARTITION (" + ", ".join(f"{column}='{value}'" for column, value in pairs) + ")"


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str] = (), location: str | None = None
) -> None:
    """Parquet table without partitions; partition columns go last.  Comments of fields are kept.

    Managed and empty, or external over the files at `location`.
    """

    def declared(f: T.StructField) -> str:
        comment = f.metadata.get("comment")
        return f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {quoted(comment)}" if comment else "")

    ordered = [f for f in schema if f.name not in partition_by]
    ordered += [schema[name] for name in partition_by]
    columns = ", ".join(map(declared, ordered))
    partitioned = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    placed = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {partitioned} {placed}")


def point_table_to(spark: SparkSession, table: str, path: str) -> None:
    """Switch an unpartitioned table to the staged folder, in one statement."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")


def point_partitions_to(spark: SparkSession, table: str, path: str, partitions: Sequence[str]) -> None:
    """Switch the named partitions to the staged folder.  Repeating it changes nothing."""
    existing = registered_partitions(spark, table)
    added = [p for p in partitions if p not in existing]
    for start in range(0, len(added), _STATEMENT_SIZE):
        clauses = [f"{_clause(p)} LOCATION '{path}/{p}'" for p in added[start : start + _STATEMENT_SIZE]]
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(clauses)}")
    for partition in partitions:
        if partition in existing:
            spark.sql(f"ALTER TABLE {table} {_clause(partition)} SET LOCATION '{path}/{partition}'")


def drop_partitions(spark: SparkSession, table: str, partitions: Sequence[str]) -> None:
    for start in range(0, len(partitions), _STATEMENT_SIZE):
        clauses = ", ".join(_clause(p) for p in partitions[start : start + _STATEMENT_SIZE])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {clauses}")


def get_property(spark: SparkSession, table: str, key: str) -> str | None:
    found = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return found.get(key)


def switch_partitions(
    spark: SparkSession, table: str, version: str, present: Sequence[str], emptied: Sequence[str] = ()
) -> None:
    """Publish staged partitions so that a crash half-way can be finished by anyone.

    What is to be done is written down first, then named in a table property, then done.
    `finish_pending` repeats the last step until the property is gone.
    """
    todo = [(p, True) for p in present] + [(p, False) for p in emptied]
    small_frame(spark, todo, "partition string, present boolean").coalesce(1).write.parquet(f"{version}/todo")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PENDING}' = '{version}')")
    finish_pending(spark, table)


def finish_pending(spark: SparkSession, table: str) -> bool:
    """Carry out a publication that was begun and not finished; True if there was one."""
    version = get_property(spark, table, PENDING)
    if version is None:
        return False
    todo = spark.read.schema("partition string, present boolean").parquet(f"{version}/todo").collect()
    point_partitions_to(spark, table, f"{version}/rows", [r.partition for r in todo if r.present])
    drop_partitions(spark, table, [r.partition for r in todo if not r.present])
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{PENDING}')")
    return True


def require_no_nulls(staged: Staged, table: str) -> None:
    broken = {c: n for c, n in staged.nulls.items() if n}
    if broken:
        raise ValueError(f"{table}: NULL in columns declared not null: {broken}")


def changed_columns(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """Columns added, removed or retyped against the stored ones."""
    held = {f.name.lower(): f.dataType.simpleString() for f in spark.table(table).schema}
    given = {f.name.lower(): f.dataType.simpleString() for f in schema}
    return sorted(c for c in held.keys() | given.keys() if held.get(c) != given.get(c))


def require_same_columns(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """The catalog keeps a table's columns, so contents of another shape would be lost or unreadable."""
    changed = changed_columns(spark, table, schema)
    if changed:
        raise ValueError(f"{table}: columns differ from the stored ones, drop the table to change them: {changed}")


def replace_contents(
    spark: SparkSession,
    table: str,
    df: DataFrame,
    partition_by: Sequence[str] = (),
    not_null: Iterable[str] = (),
    verify: Callable[[DataFrame], None] | None = None,
    spread: bool = True,
) -> Staged:
    """Give a table new contents as a whole; creates it when it is absent.

    A NULL in a `not_null` column stops the switch, and so does `verify`, which gets the
    rows as written: `df` is computed once, and the old contents stay if it fails.  Columns
    other than those of an existing table are refused before anything is written.
    """
    partition_by = list(partition_by)
    exists = spark.catalog.tableExists(table)
    if exists:
        require_same_columns(spark, table, df.schema)
    version = new_version(spark, table)
    staged = stage(df, f"{version}/rows", partition_by, not_null, spread)
    require_no_nulls(staged, table)
    if verify:
        verify(spark.read.schema(df.schema).parquet(staged.path))
    if not exists:
        create_table(spark, table, df.schema, partition_by)
    if partition_by:
        present = staged_partitions(spark, staged.path, df.schema, partition_by)
        emptied = sorted(registered_partitions(spark, table) - set(present))
        switch_partitions(spark, table, version, present, emptied)
    else:
        point_table_to(spark, table, staged.path)
    return staged
