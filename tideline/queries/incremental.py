"""Merges into stored tables: new periods, lagging feeds, moved keys, repeated keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.frames import small_frame
from tideline.functions import period_of, surrogate_key
from tideline.operators.aggregate import max_or_default
from tideline.operators.contract import SchemaMismatch
from tideline.operators.merge import DuplicateKeys, dedupe_source, high_mark, high_marks, merge_into, since, since_per_feed
from tideline.operators.quality import verify_min_rows
from tideline.operators.snapshot import Statistics, manifest, publish, stored_marks
from tideline.operators.versions import create_database
from tideline.plans import trips as plan
from tideline.queries.feeds import TRIPS_SQL, key_sql, raw_feeds, table
from tideline.queries.registry import query
from tideline.session import workspace

KEY = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate"]

_LINES_SQL = f"""
lines AS (
  SELECT {key_sql(*KEY)} AS line_key, CASE l_linestatus WHEN 'F' THEN 'yellow' ELSE 'green' END AS feed,
         l_suppkey AS vendor_id, l_extendedprice AS total_amount, l_returnflag AS flag,
         strftime(l_shipdate, '%Y-%m') AS source_period
  FROM lineitem
)"""


def lines(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    """Order lines with a key of their own, marked with the run that brought them."""
    return table(spark, sf_dir, "lineitem").select(
        surrogate_key(KEY).alias("line_key"),
        F.when(F.col("l_linestatus") == "F", "yellow").otherwise("green").alias("feed"),
        F.col("l_suppkey").alias("vendor_id"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_returnflag").alias("flag"),
        F.lit(run).alias("run"),
        period_of(F.col("l_shipdate")).alias("source_period"),
    )


def new_table(spark: SparkSession, name: str) -> str:
    """Name of a table, not made yet, in a database of its own below the shared folder."""
    folder = workspace(spark, name)
    return create_database(spark, f"{name}_{folder[-12:]}", folder) + ".lines"


def _merge(spark: SparkSession, target: str, source: DataFrame, **options) -> None:
    merge_into(spark, target, source, "line_key", "source_period", **options)


@query(f"WITH {_LINES_SQL} SELECT *, CASE WHEN source_period >= '2001-06' THEN 2 ELSE 1 END AS run FROM lines")
def merge_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First build up to a month; then everything from the newest stored month on, twice."""
    target = new_table(spark, "merge_incremental")
    _merge(spark, target, lines(spark, sf_dir, 1).where("source_period <= '2001-06'"))
    mark = high_mark(spark, target, "source_period")
    for _ in range(2):
        _merge(spark, target, lines(spark, sf_dir, 2).where(since("source_period", mark)))
    return spark.table(target)


@query(
    f"""
    WITH {_LINES_SQL}
    SELECT *, CASE WHEN source_period >= CASE feed WHEN 'yellow' THEN '2001-06' ELSE '2001-03' END THEN 2 ELSE 1 END AS run
    FROM lines
    """
)
def merge_late_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The green feed lags by three months; with a mark per feed none of its periods is missed."""
    target = new_table(spark, "merge_late_feed")
    early = "(feed = 'yellow' AND source_period <= '2001-06') OR source_period <= '2001-03'"
    _merge(spark, target, lines(spark, sf_dir, 1).where(early))
    marks = high_marks(spark.table(target), "feed", "source_period")
    _merge(spark, target, lines(spark, sf_dir, 2).where(since_per_feed("feed", "source_period", marks)))
    return spark.table(target)


@query(
    f"""
    WITH {_LINES_SQL}
    SELECT line_key, feed, vendor_id, total_amount, flag,
           CASE source_period WHEN '1995-02' THEN '1995-03' ELSE source_period END AS source_period,
           CASE source_period WHEN '1995-02' THEN 2 ELSE 1 END AS run
    FROM lines
    """
)
def merge_moved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one month come again under the next; the old month must end up empty."""
    target = new_table(spark, "merge_moved_keys")
    _merge(spark, target, lines(spark, sf_dir, 1))
    moved = lines(spark, sf_dir, 2).where("source_period = '1995-02'").withColumn("source_period", F.lit("1995-03"))
    _merge(spark, target, moved)
    return spark.table(target)


@query(f"WITH {_LINES_SQL} SELECT *, CASE WHEN source_period >= '2001-06' THEN 3 ELSE 1 END AS run FROM lines")
def merge_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source holds two versions of each key; the later one is merged."""
    target = new_table(spark, "merge_repeated_keys")
    _merge(spark, target, lines(spark, sf_dir, 1))
    again = lines(spark, sf_dir, 2).unionByName(lines(spark, sf_dir, 3)).where("source_period >= '2001-06'")
    _merge(spark, target, again, latest_by=["run"])
    return spark.table(target)


@query(
    f"""
    WITH {_LINES_SQL}
    SELECT line_key, feed, vendor_id, CAST(round(total_amount * 100) AS BIGINT) AS total_cents,
           CASE WHEN source_period >= '2001-06' THEN 3 ELSE 2 END AS run, source_period
    FROM lines
    """
)
def full_refresh_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built, then rebuilt whole by other logic, with one column more and two less, then followed by increments."""
    target = new_table(spark, "full_refresh")
    _merge(spark, target, lines(spark, sf_dir, 1), snapshot=True)

    def changed(run: int) -> DataFrame:
        cents = F.round(F.col("total_amount") * 100).cast("bigint").alias("total_cents")
        return lines(spark, sf_dir, run).select("line_key", "feed", "vendor_id", cents, "run", "source_period")

    _merge(spark, target, changed(2), full_refresh=True)
    _merge(spark, target, changed(3).where("source_period >= '2001-06'"))
    return spark.table(target)


@query(
    f"""
    WITH {_LINES_SQL}, held AS (
      SELECT feed, source_period, count(*) AS row_count, max(total_amount) AS largest, count(*) FILTER (flag IS NULL) AS without_flag
      FROM lines GROUP BY feed, source_period
    )
    SELECT feed, source_period, row_count, largest, without_flag, max(source_period) OVER (PARTITION BY feed) AS mark FROM held
    """
)
def statistics_of_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, maxima, NULLs and marks per partition and feed, as the publishing steps stored them: two builds, no scan."""
    target = new_table(spark, "stated")
    early = "(feed = 'yellow' AND source_period <= '2001-06') OR source_period <= '2001-03'"
    kept = Statistics("feed", ("total_amount",), ("flag",))
    _merge(spark, target, lines(spark, sf_dir, 1).where(early), snapshot=True, statistics=kept)
    marks = stored_marks(spark, target, "source_period")
    _merge(spark, target, lines(spark, sf_dir, 2).where(since_per_feed("feed", "source_period", marks)))
    marks = small_frame(spark, list(stored_marks(spark, target, "source_period").items()), "feed string, mark string")
    stated = manifest(spark, target).select(
        F.col("grp").alias("feed"), F.regexp_extract("partition", "source_period=(.*)", 1).alias("source_period"), "row_count",
        F.col("maxima")["total_amount"].cast("double").alias("largest"), F.col("nulls")["flag"].alias("without_flag"),
    )
    return stated.join(marks, "feed")


@query(
    f"""
    WITH {_LINES_SQL}
    SELECT *, 1 AS run, 'SchemaMismatch,SchemaMismatch,SchemaMismatch,DuplicateKeys,ValueError,ValueError' AS refused FROM lines
    """
)
def refusals_change_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column more, one less, one retyped, a key twice, a NULL and too few rows: each run is refused, the rows stay."""
    target, refused = new_table(spark, "refused"), []
    _merge(spark, target, lines(spark, sf_dir, 1), snapshot=True)
    again = lines(spark, sf_dir, 2)
    attempts = [
        lambda: _merge(spark, target, again.withColumn("more", F.lit(1))),
        lambda: _merge(spark, target, again.drop("flag")),
        lambda: _merge(spark, target, again.withColumn("vendor_id", F.col("vendor_id").cast("string"))),
        lambda: _merge(spark, target, again.unionByName(again)),
        lambda: _merge(spark, target, again.withColumn("flag", F.nullif("flag", F.lit("R"))), not_null=["flag"]),
        lambda: publish(spark, target, again.limit(3), ["source_period"], verify=lambda rows: verify_min_rows(rows, 200)),
    ]
    for attempt in attempts:
        try:
            attempt()
        except (SchemaMismatch, DuplicateKeys, ValueError) as error:
            refused.append(type(error).__name__)
    return spark.table(target).withColumn("refused", F.lit(",".join(refused)))


@query(
    f"WITH {TRIPS_SQL} SELECT trip_key, tlc_type, source_period, pickup_at, total_amount FROM trips "
    "WHERE source_period >= (SELECT coalesce(max(strftime(l_shipdate, '%Y-%m')), '1900-01') FROM lineitem "
    "WHERE l_shipdate < TIMESTAMP '2001-07-01')"
)
def watermark_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only trips of the newest loaded period and later."""
    loaded = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") < F.lit("2001-07-01").cast("timestamp_ntz"))
    periods = loaded.select(period_of(F.col("l_shipdate")).alias("source_period"))
    mark = max_or_default(periods, "source_period", plan.FIRST_PERIOD).first()[0]
    trips = plan.all_trips(*raw_feeds(spark, sf_dir)).where(since("source_period", mark))
    return trips.select("trip_key", "tlc_type", "source_period", "pickup_at", "total_amount")


@query(
    """
    SELECT event_id, ts, user_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return dedupe_source(events, "user_id", ["ts", "event_id"])
