"""Data tests.  Each gives its failing rows, so they can be counted, shown or stored."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.frames import small_frame
from tideline.functions import instant
from tideline.operators.aggregate import more_than_one, rows_per_period
from tideline.operators.snapshot import publish
from tideline.operators.versions import replace_contents

WARN_DAYS, ERROR_DAYS = 75, 120  # fixed values: freshness limits


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count."""
    return more_than_one(df.where(F.col(column).isNotNull()), column, "occurrences")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count")


def accepted_values(df: DataFrame, column: str, values: Iterable[object]) -> DataFrame:
    """Rows whose value is not in the list; NULLs pass."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values without a parent, with the number of rows that carry each; NULLs pass.

    Children are counted per value before they meet the parent, so the join is as large
    as the set of distinct values and a frequent value is no hot spot.
    """
    values = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    keys = parent.select(F.col(field).alias("__parent"))
    return values.join(keys, F.col(column) == F.col("__parent"), "left_anti")


def single_open_version(dimension: DataFrame, key: str) -> DataFrame:
    """Members with more than one version marked current."""
    return more_than_one(dimension.where("is_current"), key)


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which the expression is not true."""
    return df.where(~F.coalesce(F.expr(expression), F.lit(False)))


def unmapped_report(dimension: DataFrame) -> DataFrame:
    """Members without a name in the lookup: the list of lookup rows to add."""
    return dimension.where("is_unmapped")


def threshold_status(failures: int, warn_if: int | None, error_if: int | None) -> str:
    """`error` above `error_if`, else `warn` above `warn_if`, else `pass`."""
    if error_if is not None and failures > error_if:
        return "error"
    return "warn" if warn_if is not None and failures > warn_if else "pass"


def relationship_status(failures: DataFrame, warn_if: int = 0, error_if: int = 100) -> DataFrame:
    """One row: orphaned child rows and pass, warn or error."""
    total = failures.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("failures"))
    status = F.when(F.col("failures") > error_if, "error").when(F.col("failures") > warn_if, "warn")
    return total.withColumn("status", status.otherwise("pass"))


def freshness(
    df: DataFrame, loaded_at: str, as_of: datetime | str, warn_days: int = WARN_DAYS, error_days: int = ERROR_DAYS
) -> DataFrame:
    """Age of the newest row: pass, warn or error.  A table without rows is an error."""
    newest = df.agg(F.max(loaded_at).cast("timestamp").alias("newest"))
    age = F.unix_timestamp(instant(as_of)) - F.unix_timestamp("newest")
    status = (
        F.when(F.col("newest").isNull() | (F.col("age_seconds") > error_days * 86400), "error")
        .when(F.col("age_seconds") > warn_days * 86400, "warn")
        .otherwise("pass")
    )
    return newest.withColumn("age_seconds", age).withColumn("status", status)


def verify_load(df: DataFrame, period: str = "period") -> DataFrame:
    """Row counts of the newest periods.  No rows is an error: a wrong path loads nothing too."""
    return verify_counts(rows_per_period(df, period))


def verify_counts(counts: DataFrame) -> DataFrame:
    """As `verify_load`, for counts that are known already."""
    newest = counts.collect()
    if not newest:
        raise ValueError("table is empty after load; check the source path")
    return small_frame(counts.sparkSession, newest, counts.schema)


def verify_min_rows(df: DataFrame, minimum: int = 200) -> int:
    count = df.count()
    if count < minimum:
        raise ValueError(f"{count} rows after load, expected at least {minimum}")
    return count


@dataclass(frozen=True, eq=False)
class DataTest:
    """A named test: its failing rows, and above how many of them it warns or fails.

    A test of single rows gives its condition as `fails` on `rows`; run_tests counts all
    such tests of one frame in one pass.  A test over groups gives `failing` itself, with
    `weight` where one failing row stands for several.
    """

    name: str
    rows: DataFrame | None = None
    fails: Column | None = None
    failing: DataFrame | None = None
    weight: str | None = None
    warn_if: int | None = None
    error_if: int | None = 0

    def failing_rows(self) -> DataFrame:
        return self.rows.where(self.fails) if self.failing is None else self.failing


def not_null_test(name: str, df: DataFrame, column: str, **limits: int) -> DataTest:
    return DataTest(name, df, F.col(column).isNull(), **limits)


def accepted_values_test(name: str, df: DataFrame, column: str, values: Iterable[object], **limits: int) -> DataTest:
    outside = F.col(column).isNotNull() & ~F.col(column).isin(list(values))
    return DataTest(name, df, outside, **{"warn_if": 0, **limits})


def unique_test(name: str, df: DataFrame, column: str) -> DataTest:
    return DataTest(name, failing=unique(df, column))


def relationships_test(
    name: str, child: DataFrame, column: str, parent: DataFrame, field: str, warn_if: int = 0, error_if: int = 100
) -> DataTest:
    failing = relationships(child, column, parent, field)
    return DataTest(name, failing=failing, weight="row_count", warn_if=warn_if, error_if=error_if)


def store_failures(spark: SparkSession, table: str, failing: DataFrame) -> None:
    """Keep the failing rows of a test's last run in a table."""
    if spark.catalog.tableExists(table) and spark.table(table).dtypes != failing.dtypes:
        spark.sql(f"DROP TABLE {table}")
    replace_contents(spark, table, failing)


def run_tests(spark: SparkSession, tests: Sequence[DataTest], failures_in: str | None = None) -> DataFrame:
    """Run every test, also after a failure; one row per test.

    `failures_in` names a database that receives the failing rows, a table per test; a
    test that passes leaves its table empty.
    """
    failures: dict[str, int] = {}
    frames = {id(t.rows): t.rows for t in tests if t.failing is None}
    for frame_id, frame in frames.items():
        of_frame = [t for t in tests if id(t.rows) == frame_id]
        counts = frame.agg(*[F.count_if(t.fails).alias(t.name) for t in of_frame]).first()
        failures.update(counts.asDict())
    for test in tests:
        if test.failing is not None:
            total = F.coalesce(F.sum(test.weight), F.lit(0)) if test.weight else F.count(F.lit(1))
            failures[test.name] = test.failing.agg(total.cast("bigint")).first()[0]
    if failures_in:
        for test in tests:
            table = f"{failures_in}.{test.name}"
            if failures[test.name] or spark.catalog.tableExists(table):
                store_failures(spark, table, test.failing_rows())
    results = [(t.name, failures[t.name], threshold_status(failures[t.name], t.warn_if, t.error_if)) for t in tests]
    return small_frame(spark, results, "test string, failures bigint, status string")


FAILURES = "failing string, weight bigint, test string"


def failures_of(tests: Sequence[DataTest]) -> DataFrame | None:
    """(failing, weight, test): the failing rows of all tests, as JSON since their columns differ.

    The tests of single rows of one frame share a scan of it; a row that fails several is there for each.
    """
    parts = []
    for frame_id, frame in {id(t.rows): t.rows for t in tests if t.failing is None}.items():
        of_frame = [t for t in tests if t.failing is None and id(t.rows) == frame_id]
        failed = F.array_compact(F.array(*[F.when(t.fails, F.lit(t.name)) for t in of_frame]))
        whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in frame.columns]), {"ignoreNullFields": "false"})
        hit = frame.select(failed.alias("tests"), whole.alias("failing")).where(F.size("tests") > 0)
        parts.append(hit.select("failing", F.lit(1).cast("bigint").alias("weight"), F.explode("tests").alias("test")))
    for t in tests:
        if t.failing is not None:
            whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in t.failing.columns]), {"ignoreNullFields": "false"})
            weight = F.col(t.weight).cast("bigint") if t.weight else F.lit(1).cast("bigint")
            parts.append(t.failing.select(whole.alias("failing"), weight.alias("weight"), F.lit(t.name).alias("test")))
    return reduce(DataFrame.unionByName, parts) if parts else None


def run_and_store(spark: SparkSession, table: str, tests: Sequence[DataTest]) -> DataFrame:
    """Run every test in one job that writes all failing rows to `table`, and count what was written; one row per test.

    The table is partitioned by test.  It changes in one statement, to the rows of this run, and a run that fails leaves
    those of the last one.  Counts are sums over the stored rows, so the report and the table cannot differ.
    """
    if len({t.name for t in tests}) < len(tests):
        raise ValueError("test names are not unique")
    failing = failures_of(tests)
    if failing is None:
        failing = spark.createDataFrame([], FAILURES)
    publish(spark, table, failing, ["test"])
    stored = {r.test: r.n for r in spark.table(table).groupBy("test").agg(F.sum("weight").alias("n")).collect()}
    results = [(t.name, n := stored.get(t.name, 0), threshold_status(n, t.warn_if, t.error_if)) for t in tests]
    return small_frame(spark, results, "test string, failures bigint, status string")


def run_on_partitions(
    spark: SparkSession, table: str, tests_of: Callable[[Sequence[str]], Sequence[DataTest]], column: str, changed: Sequence[str]
) -> DataFrame:
    """As `run_and_store`, for tests of single rows, on the partitions that changed alone.

    `tests_of` gives the tests over the rows of the named partitions of `column`, which the frames must hold.  Failing rows
    of other partitions stay as they were found; the counts are those of the whole table.
    """
    tests = list(tests_of(changed))
    if any(t.failing is not None for t in tests):
        raise ValueError("tests over groups need all partitions")
    failing = failures_of(tests).withColumn("part", F.get_json_object("failing", f"$.{column}"))
    if spark.catalog.tableExists(table):
        failing = spark.table(table).where(~F.coalesce(F.col("part").isin(list(changed)), F.lit(False))).unionByName(failing)
    publish(spark, table, failing.select("failing", "weight", "part", "test"), ["test"])
    stored = {r.test: r.n for r in spark.table(table).groupBy("test").agg(F.sum("weight").alias("n")).collect()}
    results = [(t.name, n := stored.get(t.name, 0), threshold_status(n, t.warn_if, t.error_if)) for t in tests]
    return small_frame(spark, results, "test string, failures bigint, status string")
