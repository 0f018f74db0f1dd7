"""Load each file version once into an append-only raw table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from itertools import islice

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.frames import small_frame
from tideline.operators.versions import (
    NULL_FOLDER, create_table, delete_folder, drop_partitions, partition_columns, registered_partitions,
)
from tideline.session import workspace
from tideline.sources.drift import schema_fingerprints, shapes_of, widen_schemas, widen_type
from tideline.sources.files import LINEAGE, list_files, with_lineage

BATCH = "_batch_id"
ORIGIN = "_loaded_batch"  # in rows that were folded: the batch that brought them
FILES_PER_BATCH = 100_000
_FILES = "path string, modified_us bigint, length bigint"
_SHAPE = "columns array<string>, schema_hash string, type_hash string, spark_schema string"
_PARTS = f"partition string, row_count bigint, newest timestamp, {BATCH} string"
_FOLDS = f"partition string, replaced array<string>, row_count bigint, committed_at timestamp, {BATCH} string"


@dataclass(frozen=True)
class LoadSummary:
    batch_id: str | None
    files_loaded: int
    rows_inserted: int
    files_skipped: int


def ledger_tables(table: str) -> tuple[str, str]:
    """The files of each batch, and the batches that were completed."""
    return f"{table}__files", f"{table}__batches"


def statistics_table(table: str) -> str:
    """Rows and newest load time of each partition of each batch, written by the load."""
    return f"{table}__parts"


def folds_table(table: str) -> str:
    """Partitions whose batches were written together (`fold.fold_batches`), one row each."""
    return f"{table}__folds"


def _ensure_ledger(spark: SparkSession, table: str) -> None:
    files, batches = ledger_tables(table)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {files} ({_FILES}, {_SHAPE}, {BATCH} string) USING parquet")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {batches} ({BATCH} string, committed_at timestamp, "
        "file_count bigint, row_count bigint) USING parquet"
    )
    spark.sql(f"CREATE TABLE IF NOT EXISTS {statistics_table(table)} ({_PARTS}) USING parquet")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {folds_table(table)} ({_FOLDS}) USING parquet")


def loaded_files(spark: SparkSession, table: str) -> DataFrame:
    """File versions in completed batches."""
    files, batches = ledger_tables(table)
    return spark.table(files).join(spark.table(batches).select(BATCH), BATCH, "left_semi")


def create_like(
    spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str] = ("period",)
) -> None:
    """Table without rows: the columns of representative files, plus lineage."""
    data = [T.StructField(f.name, f.dataType, True, f.metadata) for f in schema if f.name not in partition_by]
    keys = [T.StructField(name, T.StringType()) for name in partition_by]
    create_table(
        spark, table, T.StructType(data + list(LINEAGE) + keys + [T.StructField(BATCH, T.StringType())]),
        [*partition_by, BATCH],
    )


def evolve_table(spark: SparkSession, table: str, incoming: T.StructType) -> list[str]:
    """Add the columns a table lacks; rows already there read NULL.  Returns their names.

    The type of an existing column stays.  A narrower or equal incoming type fits it; a
    wider integer is stored by checked cast, which fails on overflow; anything else is
    refused.
    """
    existing = {f.name.lower(): f.dataType for f in spark.table(table).schema}
    new = [f for f in incoming if f.name.lower() not in existing]
    for f in incoming:
        target = existing.get(f.name.lower(), f.dataType)
        both_integers = isinstance(f.dataType, T.IntegralType) and isinstance(target, T.IntegralType)
        if not both_integers and widen_type(target, f.dataType) != target:
            raise ValueError(f"{table}: {f.name} is {target.simpleString()}, got {f.dataType.simpleString()}")
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def decoded(name: Column) -> Column:
    """A partition's name or value without the escapes of folder names."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def stored_partitions(spark: SparkSession, table: str) -> DataFrame:
    """(name, partition, _batch_id, state) of the table's partitions, from the catalog and the ledger.

    `name` is the whole name, `partition` what stands before the batch in it, without escapes.  `state` is `live`, `folded` (its rows
    are in a later fold as well) or `unfinished` (written and never completed).  All of them are as of this call: a
    frame over live partitions sees one state, whatever is loaded or folded while it runs.
    """
    names = spark.sql(f"SHOW PARTITIONS {table}").select(
        F.col("partition").alias("name"),
        decoded(F.regexp_replace("partition", f"/?{BATCH}=[^/]*$", "")).alias("partition"),
        F.regexp_extract("partition", f"{BATCH}=([^/]*)", 1).alias(BATCH),
    )
    folds = spark.table(folds_table(table))
    done = spark.table(ledger_tables(table)[1]).select(BATCH).union(folds.select(BATCH)).distinct().withColumn("__done", F.lit(True))
    gone = folds.select("partition", F.explode("replaced").alias(BATCH)).distinct().withColumn("__gone", F.lit(True))
    state = F.when(F.col("__done").isNull(), "unfinished").when(F.col("__gone"), "folded").otherwise("live")
    found = names.join(done, BATCH, "left").join(gone, ["partition", BATCH], "left").select("name", "partition", BATCH, state.alias("state"))
    return small_frame(spark, found.collect(), f"name string, partition string, {BATCH} string, state string")


def drop_unfinished(spark: SparkSession, table: str) -> list[str]:
    """Remove rows of batches that were written but never completed."""
    stale = stored_partitions(spark, table).where("state = 'unfinished'").collect()
    drop_partitions(spark, table, [r.name for r in stale])
    return sorted({r[BATCH] for r in stale})


def copy_into(
    spark: SparkSession,
    table: str,
    source_dir: str,
    partition_by: Sequence[str] = ("period",),
    loaded_at: datetime | None = None,
    actor: str | None = None,
    glob: str = "*.parquet",
    modified_after: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> LoadSummary:
    """Append the files below `source_dir` that no completed batch holds.

    A file version is its path, modification time and length: a file replaced at the
    same path is a new version and is appended as another batch.  The ledger lists the batch's
    files with the schemas in their footers, which are read here and nowhere else; rows are written to
    partitions of the batch; then one ledger row completes it.  A crash before that row leaves a batch that the next run drops and
    loads again, so no row is ever loaded twice or lost.  One load per table at a time.

    The folder is listed once.  The driver sees names of new files, never rows, and of no more than
    `files_per_batch` at once; what exceeds them follows in further batches of the same call.

    `modified_after` leaves older files out of the listing, for landing folders with a
    long past; files that keep an old modification time when copied there need it off.
    """
    _ensure_ledger(spark, table)
    if spark.catalog.tableExists(table):
        drop_unfinished(spark, table)
    found, pending = Observation(), workspace(spark, "pending")
    listing = list_files(spark, source_dir, glob, modified_after).observe(found, F.count(F.lit(1)).alias("files"))
    listing = listing.select("path", F.unix_micros("modified_at").alias("modified_us"), "length")
    listing.join(loaded_files(spark, table), ["path", "modified_us", "length"], "left_anti").write.parquet(pending)
    names = spark.read.schema(_FILES).parquet(pending).toLocalIterator()
    batch, loaded, inserted = None, 0, 0
    while new_files := [tuple(row) for row in islice(names, files_per_batch)]:
        batch, row_count = _load_batch(spark, table, source_dir, new_files, partition_by, loaded_at, actor)
        loaded, inserted = loaded + len(new_files), inserted + row_count
    delete_folder(spark, pending)
    return LoadSummary(batch, loaded, inserted, found.get["files"] - loaded)


def _load_batch(
    spark: SparkSession,
    table: str,
    source_dir: str,
    new_files: list[tuple],
    partition_by: Sequence[str],
    loaded_at: datetime | None,
    actor: str | None,
) -> tuple[str, int]:
    """One batch of files: their ledger rows, a schema that fits them all, one scan, completion."""
    batch_id = uuid.uuid4().hex
    files = small_frame(spark, new_files, _FILES)
    prints = schema_fingerprints(files, file_count=len(new_files))
    listed = files.join(prints, "path").withColumn(BATCH, F.lit(batch_id))
    ledger_files = ledger_tables(table)[0]
    listed.select(*spark.table(ledger_files).columns).write.insertInto(ledger_files)
    schema = widen_schemas(shapes_of(spark.table(ledger_files).where(F.col(BATCH) == batch_id)))
    if spark.catalog.tableExists(table):
        evolve_table(spark, table, schema)
    else:
        create_like(spark, table, schema, partition_by)

    keyed = T.StructType([*schema, *[T.StructField(c, T.StringType()) for c in partition_by]])
    rows = spark.read.schema(keyed).option("basePath", source_dir).parquet(*[path for path, *_ in new_files])
    rows = with_lineage(rows, loaded_at, actor).withColumn(BATCH, F.lit(batch_id))
    target = spark.table(table)
    present = {c.lower() for c in rows.columns}
    ordered = rows.select(
        *[
            (F.col(f.name) if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema
        ]
    )
    watch = Observation()
    ordered.observe(watch, F.count(F.lit(1)).alias("rows")).write.insertInto(table)
    row_count = watch.get["rows"]
    _note_statistics(spark, table, batch_id)
    record_batch(spark, table, batch_id, len(new_files), row_count)
    return batch_id, row_count


def partition_column(keys: Sequence[str]) -> Column:
    """The name of a row's partition up to the batch, without escapes."""
    named = [F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit(NULL_FOLDER))) for k in keys]
    return F.concat_ws("/", *named) if named else F.lit("")


def _note_statistics(spark: SparkSession, table: str, batch_id: str) -> None:
    """Rows and newest load time per partition of a batch just written: one column of the new files is read."""
    keys = [c for c in partition_columns(spark, table) if c != BATCH]
    rows = spark.table(table).where(F.col(BATCH) == batch_id)
    parts = rows.groupBy(partition_column(keys).alias("partition")).agg(
        F.count(F.lit(1)).alias("row_count"), F.max("_loaded_at").alias("newest")
    )
    parts.withColumn(BATCH, F.lit(batch_id)).coalesce(1).write.insertInto(statistics_table(table))


def partition_statistics(spark: SparkSession, table: str) -> DataFrame:
    """(partition, _batch_id, row_count, newest) of completed batches, as loaded; folding changes none of them."""
    return spark.table(statistics_table(table)).join(spark.table(ledger_tables(table)[1]).select(BATCH), BATCH, "left_semi")


def rows_per_loaded_period(spark: SparkSession, table: str, period: str = "period") -> DataFrame:
    """(period, row_count) of the completed batches, from the statistics: no row is read."""
    value = F.regexp_extract("partition", f"(?:^|/){period}=([^/]*)", 1)
    named = partition_statistics(spark, table).select(F.when(value != NULL_FOLDER, value).alias(period), "row_count")
    return named.groupBy(period).agg(F.sum("row_count").alias("row_count"))


def record_batch(spark: SparkSession, table: str, batch_id: str, file_count: int, row_count: int) -> None:
    """Complete a batch: one row, so it is there or it is not."""
    ledger_batches = ledger_tables(table)[1]
    done = spark.range(1, numPartitions=1).select(
        F.lit(batch_id), F.current_timestamp(), F.lit(file_count).cast("bigint"), F.lit(row_count).cast("bigint")
    )
    done.write.insertInto(ledger_batches)


def committed(spark: SparkSession, table: str) -> DataFrame:
    """Rows of completed batches only, each once, for readers that may meet a load or a fold in progress.

    The batch is a partition column, so the semi join prunes whole partitions.
    """
    return _live(spark, table, stored_partitions(spark, table).where("state = 'live'"))


def _live(spark: SparkSession, table: str, wanted: DataFrame) -> DataFrame:
    """Rows of the partitions `wanted` (partition, _batch_id)."""
    raw = spark.table(table)
    keys = [c for c in partition_columns(spark, table) if c != BATCH]
    named = wanted.select(F.col(BATCH).alias("__batch"), F.col("partition").alias("__partition"))
    return raw.join(named, (raw[BATCH] == F.col("__batch")) & (partition_column(keys) == F.col("__partition")), "left_semi")


def origin(rows: DataFrame) -> Column:
    """The batch that brought a row, whether or not it was folded since."""
    return F.coalesce(F.col(ORIGIN), F.col(BATCH)) if ORIGIN in rows.columns else F.col(BATCH)


def rows_of_batches(spark: SparkSession, table: str, batches: Sequence[str]) -> DataFrame:
    """Rows that the named completed batches brought; reads their partitions, and folds that hold one of them."""
    live = stored_partitions(spark, table).where("state = 'live'")
    mine = F.col(BATCH).isin(list(batches))
    holding = _held(spark, table).where(F.col("held").isin(list(batches))).select("partition", BATCH)
    wanted = live.where(mine).select("partition", BATCH).union(live.join(holding, ["partition", BATCH], "left_semi").select("partition", BATCH))
    rows = _live(spark, table, wanted)
    return rows.where(origin(rows).isin(list(batches)))


def _held(spark: SparkSession, table: str) -> DataFrame:
    """(partition, _batch_id, held): the loaded batches whose rows a fold holds, earlier folds resolved.

    A fold takes batches and earlier folds; each row of the ledger names what it took directly."""
    folds = spark.table(folds_table(table)).select("partition", BATCH, F.explode("replaced").alias("held"))
    found = folds
    ids = {r[0] for r in folds.select(BATCH).distinct().collect()}  # one per fold run
    while True:
        inner = folds.select("partition", F.col(BATCH).alias("held"), F.col("held").alias("deeper"))
        deeper = found.where(F.col("held").isin(list(ids))).join(inner, ["partition", "held"]).select("partition", BATCH, F.col("deeper").alias("held"))
        if deeper.isEmpty():
            return found
        found = found.where(~F.col("held").isin(list(ids))).union(deeper)


def _one_spelling(path: str) -> Column:
    """`file:/a`, `file:///a`: one path, as listings and scans spell it."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def latest_files(spark: SparkSession, table: str, present: DataFrame | None = None) -> DataFrame:
    """Rows of completed batches, of each file only its newest loaded version.

    For sources that restate a file in place: raw keeps every version, this view reads the last
    one of each path, whatever batch brought it, so a load that was split or a late file of a
    period hides nothing.  A file that has gone from the landing folder keeps its rows, unless
    `present` (a listing with `path`) says which files count: for sources that replace a
    file by one of another name.  Within one modification time the later batch wins.  Batches without a current file are pruned.
    """
    files, batches = ledger_tables(table)
    done = spark.table(batches).select(BATCH, "committed_at")
    newest = (
        spark.table(files).join(done, BATCH).groupBy("path")
        .agg(F.max(F.struct("modified_us", "committed_at", BATCH)).alias("last"))
        .select(_one_spelling("path").alias("__path"), F.col(f"last.{BATCH}").alias(BATCH))
    )
    if present is not None:
        newest = newest.join(present.select(_one_spelling("path").alias("__path")), "__path", "left_semi")
    live = stored_partitions(spark, table).where("state = 'live'")
    current = newest.select(BATCH).union(spark.table(folds_table(table)).select(BATCH)).distinct()
    raw = _live(spark, table, live.join(current, BATCH, "left_semi"))
    rows = raw.withColumns({"__path": _one_spelling("_loaded_from"), "__origin": origin(raw)})
    return rows.join(newest.withColumnRenamed(BATCH, "__origin"), ["__path", "__origin"], "left_semi").select(*raw.columns)


def reset(spark: SparkSession, table: str, keep_ledger: bool = False) -> None:
    """Empty a table and forget what was loaded, so that the next load takes everything.

    With `keep_ledger` only the rows go: files stay marked as loaded.
    """
    # Batches first: rows without one are an unfinished load, which the next load drops and repeats.
    if not keep_ledger:
        files, batches = ledger_tables(table)
        spark.sql(f"TRUNCATE TABLE {batches}")
        for ledger in (folds_table(table), files, statistics_table(table)):
            spark.sql(f"TRUNCATE TABLE {ledger}")
    drop_partitions(spark, table, sorted(registered_partitions(spark, table)))
