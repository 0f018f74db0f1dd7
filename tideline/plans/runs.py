"""The runs from landed files to published tables.  Each may be repeated after a failure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.frames import small_frame
from tideline.functions import instant
from tideline.operators.aggregate import observe_keys, sum_observations
from tideline.operators.contract import build_table, enforce_contract
from tideline.operators.governance import apply_contract_governance
from tideline.operators.fold import expire_folded, fold_batches
from tideline.operators.ingest import (
    BATCH, LoadSummary, copy_into, ledger_tables, partition_statistics, rows_of_batches, rows_per_loaded_period,
)
from tideline.operators.maintain import RETAIN_DAYS, TARGET_BYTES, compact, describe_detail, expire_versions
from tideline.operators.merge import MergeResult, high_mark, high_marks, merge_into, since
from tideline.operators.quality import ERROR_DAYS, WARN_DAYS, freshness, run_tests, verify_counts
from tideline.operators.replace import replace_table
from tideline.operators.scd2 import open_versions, present_dimension, scd2_apply
from tideline.operators.snapshot import Statistics, is_snapshot, stored_marks
from tideline.operators.versions import replace_contents
from tideline.plans import trips as plan
from tideline.plans.checks import lookup_tests
from tideline.sources.drift import schema_drift
from tideline.sources.files import check_sizes, list_files, scan_csv
from tideline.sources.reference import archive_copy, content_changed, content_hashes, load_seed, validate_reference


_OBSERVED = (
    "vendor_id bigint, first_seen_at timestamp, last_seen_at timestamp, trip_count bigint, "
    "tlc_type string, batches array<string>"
)


@dataclass(frozen=True)
class LoadReport:
    summary: LoadSummary
    drift: list[str]
    newest: list[tuple[str, int]]


def load_feed(
    spark: SparkSession,
    raw: str,
    source_dir: str,
    dataset: str,
    expected_sizes: DataFrame | None = None,
    loaded_at: datetime | None = None,
    actor: str | None = None,
) -> LoadReport:
    """Landed files into a raw table: sizes, load, drift, verification.

    Drift compares the shapes of the loaded files, as the ledger has them, with those of earlier loads,
    kept in `<raw>__shapes`, and informs; sizes and an empty table fail the run.  Row counts of the newest
    periods come from the statistics of the loads.
    """
    if expected_sizes is not None:
        check_sizes(list_files(spark, source_dir, "*.parquet"), expected_sizes)
    summary = copy_into(spark, raw, source_dir, loaded_at=loaded_at, actor=actor)
    shapes = f"{raw}__shapes"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {shapes} (dataset string, schema_hash string, {BATCH} string) USING parquet")
    drift: list[str] = []
    noted = spark.table(shapes).select(BATCH).distinct()
    unseen = spark.table(ledger_tables(raw)[1]).join(noted, BATCH, "left_anti").select(BATCH)
    if not unseen.isEmpty():
        files = spark.table(ledger_tables(raw)[0]).join(unseen, BATCH, "left_semi")
        prints = files.select(F.lit(dataset).alias("dataset"), "schema_hash", BATCH, "columns").distinct()
        found = schema_drift(prints, spark.table(shapes)).select(F.concat_ws(",", "columns").alias("c")).distinct()
        drift = sorted(row.c for row in found.collect())
        prints.select("dataset", "schema_hash", BATCH).write.insertInto(shapes)
    counts = rows_per_loaded_period(spark, raw).orderBy(F.desc("period")).limit(12)
    newest = [(r.period, r.row_count) for r in verify_counts(counts).collect()]
    return LoadReport(summary, drift, newest)


def refresh_reference(
    spark: SparkSession,
    table: str,
    csv_path: str,
    landing: str,
    state: str,
    header: Sequence[str] = plan.ZONE_HEADER,
    min_rows: int = 200,
    at: datetime | None = None,
) -> str:
    """A reference CSV into its table; `unchanged`, `landed` or `reloaded`.

    Validated first, then compared by content.  The state is noted after landing, so a
    table load that fails is repeated from the landed copy alone: the table carries the
    hash it was loaded from, and one that differs from the state is loaded again.
    """
    at = at or datetime.now(timezone.utc)
    rows = validate_reference(spark, csv_path, header, min_rows)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {state} (path string, sha256 string, row_count bigint, archive string, "
        "landed_at timestamp) USING parquet"
    )
    seen = content_changed(content_hashes(spark, csv_path), spark.table(state)).first()
    if seen.changed:
        raw = spark.read.option("header", True).csv(csv_path)
        archive = archive_copy(raw.toDF(*header), landing, "reference", at)
        note = spark.range(1).select(
            F.lit(seen.path), F.lit(seen.sha256), F.lit(rows).cast("bigint"), F.lit(archive), instant(at)
        )
        note.write.insertInto(state)
    elif spark.catalog.tableExists(table):
        stored = spark.table(table).select("_source_sha256").first()
        if stored and stored[0] == seen.sha256[:16]:
            return "unchanged"
    key, *others = header
    schema = ", ".join([f"`{key}` bigint", *[f"`{c}` string" for c in others]])
    current = scan_csv(spark, f"{landing}/current/reference", schema)
    replace_table(spark, table, current.toDF(*[c.lower() for c in header]), seen.sha256, at, min_rows)
    return "landed" if seen.changed else "reloaded"


def reload_seeds(
    spark: SparkSession, database: str, folder: str, seeds: Mapping[str, str] = plan.SEEDS, at: datetime | None = None
) -> dict[str, DataFrame]:
    """Code lists from `<folder>/<name>.csv` into tables of `database`, each replaced whole, so removed codes vanish.

    The first declared column is the key.  Every list is read with its declared types, its header checked and its key
    tested (present, occurs once) before any table is replaced; one that fails refuses the run, and all tables
    stay.  Returns the stored lists, in the order of `seeds`.
    """
    read, keys, hashes = {}, {}, {}
    for name, schema in seeds.items():
        path = f"{folder}/{name}.csv"
        read[name] = load_seed(spark, path, schema)
        validate_reference(spark, path, read[name].columns, min_rows=1)
        keys[name] = (read[name], read[name].columns[0])
        # One hash per file; a list written in several parts is known by the hash of theirs.
        parts = F.array_sort(F.collect_list("sha256"))
        one = F.when(F.size(parts) == 1, parts[0]).otherwise(F.sha2(F.array_join(parts, ","), 256))
        hashes[name] = content_hashes(spark, path).agg(one.alias("sha256")).first().sha256
    failed = run_tests(spark, lookup_tests(keys)).where("failures > 0").collect()
    if failed:
        raise ValueError(f"seeds refused: {', '.join(f'{r.test}: {r.failures}' for r in failed)}")
    for name, rows in read.items():
        replace_table(spark, f"{database}.{name}", rows, hashes[name], at, min_rows=1)
    return {name: spark.table(f"{database}.{name}").drop("_loaded_at", "_source_sha256") for name in seeds}


def refresh_vendor_dimension(
    spark: SparkSession, history: str, dimension: str, trips: DataFrame, vendors: DataFrame, as_of: datetime
) -> None:
    """Observed vendors into their history, and the history into the dimension.

    Only the name makes a version; when a vendor was last seen changes with every run.
    Reads all `trips`; `refresh_vendors_of_loads` reads those of new loads only.
    """
    _publish_vendors(spark, history, dimension, plan.observed_vendors(trips, vendors), as_of)


def note_vendors(spark: SparkSession, observed: str, raw_yellow: str, raw_green: str) -> int:
    """Vendors met in completed loads that were not noted before, appended to `observed`; the number of loads.

    The batch is a partition column of a raw table, so only partitions of new loads are read, or the folds they are in.  The
    vendors of a load and the note of it, a row without vendor, are one write.  A vendor met only in
    a file version that was replaced later stays noted, as a vendor that vanishes stays in the dimension.
    """
    spark.sql(f"CREATE TABLE IF NOT EXISTS {observed} ({_OBSERVED}) USING parquet")
    loads = 0
    for raw, trips_of, feed in ((raw_yellow, plan.yellow_trips, plan.YELLOW), (raw_green, plan.green_trips, plan.GREEN)):
        noted = spark.table(observed).where(F.col("tlc_type") == feed).select(F.explode("batches").alias(BATCH))
        done = spark.table(ledger_tables(raw)[1]).select(BATCH)
        batches = sorted(r[0] for r in done.join(noted, BATCH, "left_anti").collect())
        if batches:
            trips = trips_of(rows_of_batches(spark, raw, batches))
            met = observe_keys(trips.select("vendor_id", "pickup_at"), "vendor_id", "pickup_at")
            note = spark.range(1).select(F.array(*map(F.lit, batches)).alias("batches"))
            rows = met.unionByName(note, allowMissingColumns=True).withColumn("tlc_type", F.lit(feed))
            rows.select(*spark.table(observed).columns).coalesce(1).write.insertInto(observed)
        loads += len(batches)
    return loads


def refresh_vendors_of_loads(
    spark: SparkSession, history: str, dimension: str, observed: str, raw_yellow: str, raw_green: str,
    vendors: DataFrame, as_of: datetime,
) -> int:
    """As `refresh_vendor_dimension`, from stored observations and the loads since; the number of loads read."""
    loads = note_vendors(spark, observed, raw_yellow, raw_green)
    met = spark.table(observed).where(F.col("vendor_id").isNotNull()).drop("tlc_type", "batches")
    _publish_vendors(spark, history, dimension, plan.named_vendors(sum_observations(met, "vendor_id"), vendors), as_of)
    return loads


def _publish_vendors(spark: SparkSession, history: str, dimension: str, observed: DataFrame, as_of: datetime) -> None:
    current = observed.select("vendor_id", "vendor_name", "is_unmapped")
    if spark.catalog.tableExists(history):
        versions = scd2_apply(spark.table(history), current, "vendor_id", ["vendor_name"], as_of)
    else:
        versions = open_versions(current, "vendor_id", as_of)
    replace_contents(spark, history, versions)
    presented = present_dimension(spark.table(history), "vendor_id", "vendor_key")
    build_table(spark, dimension, presented, plan.VENDOR_CONTRACT)
    apply_contract_governance(spark, dimension, plan.VENDOR_CONTRACT)


def refresh_trip_fact(
    spark: SparkSession,
    fact: str,
    raw_yellow: DataFrame,
    raw_green: DataFrame,
    dimension: str,
    code_lists: tuple[DataFrame, DataFrame, DataFrame],
    updated_at: datetime | None = None,
    updated_by: str | None = None,
    full_refresh: bool = False,
    mark_per_feed: bool = True,
    periods: Sequence[str] | None = None,
    latest_by: Sequence[str] = (),
    snapshot: bool = False,
) -> MergeResult:
    """Trips of the newest stored period and later into the fact, merged on the trip key.

    Each feed is followed by its own mark, so one that lags behind loses nothing; with
    `mark_per_feed` off one mark serves both.  `periods` names months instead, for files
    restated after they were loaded: those months are replaced, and trips that are no longer
    in them leave the fact.  Give `ingest.latest_files` of the raw tables for them.  `latest_by` keeps
    the last of several rows with one key; without it they fail the run.  A full refresh
    reads everything and is for the first build and for changed logic.

    With `snapshot` the fact is a name over snapshots: its partitions change in one statement, a refresh may change
    its columns, and the marks come from its manifest instead of a scan.
    """
    feeds = {plan.YELLOW: raw_yellow, plan.GREEN: raw_green}
    if spark.catalog.tableExists(fact) and not full_refresh:
        mark = high_mark(spark, fact, "source_period", plan.FIRST_PERIOD)
        marks = {}
        if mark_per_feed:
            pointed = is_snapshot(spark, fact)
            marks = stored_marks(spark, fact, "source_period") if pointed else high_marks(spark.table(fact), "tlc_type", "source_period")
        for label, raw in feeds.items():
            if periods is not None:
                wanted = F.col("period").isin(list(periods))
            else:
                wanted = since("period", marks.get(label, plan.FIRST_PERIOD) if mark_per_feed else mark)
            feeds[label] = raw.where(wanted)
    trips = plan.all_trips(feeds[plan.YELLOW], feeds[plan.GREEN])
    rows = plan.trip_fact(trips, spark.table(dimension), *code_lists, updated_at, updated_by)
    result = merge_into(
        spark, fact, enforce_contract(rows, plan.TRIP_CONTRACT), "trip_key", "source_period",
        latest_by=latest_by, not_null=plan.TRIP_CONTRACT.required, full_refresh=full_refresh, by_partition=not latest_by,
        replaces=list(periods or ()), key_date="pickup_date", snapshot=snapshot,
        statistics=Statistics("tlc_type", ("updated_at",), tuple(plan.TRIP_CONTRACT.required)) if snapshot else None,
    )
    if result.mode == "full":
        apply_contract_governance(spark, fact, plan.TRIP_CONTRACT)
    return result


def check_raw_freshness(
    spark: SparkSession, raw_tables: Sequence[str], as_of: datetime, warn_days: int = WARN_DAYS, error_days: int = ERROR_DAYS
) -> dict[str, str]:
    """`pass` or `warn` of each raw table by its newest `_loaded_at`; an error fails the run.

    The newest load time is in the statistics of the loads: no row is read.
    """
    found = {}
    for raw in raw_tables:
        found[raw] = freshness(partition_statistics(spark, raw), "newest", as_of, warn_days, error_days).first().status
    stale = sorted(t for t, status in found.items() if status == "error")
    if stale:
        raise ValueError(f"not loaded for more than {error_days} days: {stale}")
    return found


def upkeep(
    spark: SparkSession, tables: dict[str, str], target_bytes: int = TARGET_BYTES,
    retain_days: int = RETAIN_DAYS, now: datetime | None = None,
) -> DataFrame:
    """Compact each table by its column, delete expired versions, and report files and bytes; one row per table."""
    report = []
    for table, cluster_by in tables.items():
        rewritten = compact(spark, table, cluster_by, target_bytes)
        deleted = len(expire_versions(spark, table, retain_days, now))
        detail = describe_detail(spark.table(table)).first()
        report.append((table, rewritten, deleted, detail.num_files, detail.size_in_bytes))
    return small_frame(
        spark, report,
        "table_name string, partitions_rewritten int, versions_deleted int, num_files bigint, size_in_bytes bigint",
    )


def upkeep_raw(
    spark: SparkSession, tables: dict[str, str | None], target_bytes: int = TARGET_BYTES, retain_days: int = RETAIN_DAYS, now: datetime | None = None
) -> DataFrame:
    """Fold the loads of each raw table (by a column, or None) and drop what was folded long ago; one row per table."""
    report = []
    for raw, cluster_by in tables.items():
        folded = fold_batches(spark, raw, cluster_by, target_bytes)
        report.append((raw, folded, expire_folded(spark, raw, retain_days, now)))
    return small_frame(spark, report, "table_name string, partitions_folded int, partitions_dropped int")
