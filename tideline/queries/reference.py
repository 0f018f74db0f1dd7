"""Reference files: validated, compared by content, archived, and replaced as a whole."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.replace import replace_table
from tideline.operators.versions import create_database
from tideline.plans.trips import zone_reference
from tideline.queries.conform import STAND_IN_SENTINELS, raw_zones
from tideline.queries.feeds import table
from tideline.queries.registry import query
from tideline.session import workspace
from tideline.sources.archive import archive_files, contents
from tideline.sources.files import scan_csv
from tideline.sources.reference import archive_copy, content_changed, content_hashes, load_seed, validate_reference

LOADED_AT = datetime(2025, 1, 1)
_ZONE_SCHEMA = "locationid bigint, borough string, zone string, service_zone string"
_CUSTOMERS = "customer_id bigint, customer_name string, nation_id int, balance double, segment string"


@query(
    """
    SELECT CAST(n_nationkey AS BIGINT) AS location_id, r_name AS borough, n_name AS zone_name,
           'Zone ' || n_nationkey AS service_zone, n_nationkey IN (23, 24) AS is_unknown_zone,
           TIMESTAMP '2025-01-01 00:00:00' AS loaded_at
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
    """
)
def reference_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to table: landed with an archive copy, validated, and loaded twice over."""
    folder = workspace(spark, "zones")
    zones = raw_zones(spark, sf_dir).drop("_loaded_at")
    archive_copy(zones, folder, "zones", LOADED_AT)
    current = f"{folder}/current/zones"
    validate_reference(spark, current, zones.columns, min_rows=20)
    database = create_database(spark, f"zones_{folder[-12:]}", f"{folder}/db")
    for _ in range(2):
        replace_table(spark, f"{database}.zones", scan_csv(spark, current, _ZONE_SCHEMA), "0" * 64, LOADED_AT, 20)
    return zone_reference(spark.table(f"{database}.zones"), STAND_IN_SENTINELS)


@query(
    """
    SELECT CAST(n_nationkey AS BIGINT) AS location_id, n_name AS zone_name, r_name AS borough, '0000000000000000' AS _source_sha256,
           25 AS seen_by_earlier_reader, 'location_id,zone_name' AS earlier_columns
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
    """
)
def replace_with_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference table is replaced by one with another column, in one statement; who began before reads on."""
    folder = workspace(spark, "zones")
    name = create_database(spark, f"zones_{folder[-12:]}", f"{folder}/db") + ".zones"
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    zones = nations.select(F.col("n_nationkey").cast("bigint").alias("location_id"), F.col("n_name").alias("zone_name"), "n_regionkey")
    replace_table(spark, name, zones.drop("n_regionkey"), "0" * 64, LOADED_AT, 20)
    earlier = spark.table(name).drop("_loaded_at", "_source_sha256")
    wider = zones.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        "location_id", "zone_name", F.col("r_name").alias("borough")
    )
    replace_table(spark, name, wider, "0" * 64, LOADED_AT, 20)
    return spark.table(name).drop("_loaded_at").withColumns(
        {"seen_by_earlier_reader": F.lit(earlier.count()).cast("int"), "earlier_columns": F.lit(",".join(earlier.columns))}
    )


@query(
    """
    SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id, c_acctbal AS balance,
           c_mktsegment AS segment FROM customer
    """
)
def typed_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list written as CSV and read back with declared types."""
    folder = workspace(spark, "seed")
    table(spark, sf_dir, "customer").write.option("header", True).csv(folder)
    return load_seed(spark, folder, _CUSTOMERS)


@query(
    """
    WITH looks AS (
      SELECT n_regionkey AS part, false AS repeated, 'first' AS look FROM nation
      UNION ALL SELECT n_regionkey, true, 'again' FROM nation
      UNION ALL SELECT n_regionkey, n_regionkey <> 1, 'edited' FROM nation
    )
    SELECT DISTINCT look, CAST(part AS VARCHAR) AS part, NOT repeated AS changed FROM looks
    """
)
def content_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files compared with their last landed hash: at first, untouched, and after one was edited."""
    nations = table(spark, sf_dir, "nation")

    def hashes(rows: DataFrame) -> DataFrame:
        folder = workspace(spark, "content")
        rows.repartition("n_regionkey").sortWithinPartitions("n_nationkey").write.partitionBy("n_regionkey").csv(folder)
        part = F.regexp_extract("path", "n_regionkey=([^/]+)/", 1).alias("path")
        return content_hashes(spark, folder).select(part, "sha256")

    edited = F.when(F.col("n_regionkey") == 1, F.lower("n_name")).otherwise(F.col("n_name"))
    first, again, last = hashes(nations), hashes(nations), hashes(nations.withColumn("n_name", edited))
    empty = first.limit(0).withColumn("landed_at", F.current_timestamp())
    landed = first.withColumn("landed_at", F.current_timestamp())
    looks = [("first", first, empty), ("again", again, landed), ("edited", last, landed)]
    results = [
        content_changed(seen, ledger).select(F.lit(name).alias("look"), F.col("path").alias("part"), "changed")
        for name, seen, ledger in looks
    ]
    return results[0].unionByName(results[1]).unionByName(results[2])


@query(
    """
    SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id, c_acctbal AS balance,
           c_mktsegment AS segment, true AS same_bytes FROM customer
    """
)
def archived_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files are archived byte for byte; the rows come from the archive, the hashes from both sides."""
    folder = workspace(spark, "archive")
    source = f"{folder}/source"
    table(spark, sf_dir, "customer").repartition(3).write.option("header", True).csv(source)
    archive_files(spark, source, f"{folder}/kept", LOADED_AT)
    kept = contents(spark, f"{folder}/kept", LOADED_AT.strftime("%Y%m%d%H%M%S"))
    hashes = content_hashes(spark, f"{source}/*.csv").withColumnRenamed("sha256", "source_sha256")
    both = kept.join(hashes, "path").withColumn("same_bytes", F.sha2("content", 256) == F.col("source_sha256"))
    lines = both.select("same_bytes", F.posexplode(F.split(F.decode("content", "utf-8"), "\n")).alias("n", "line")).where("n > 0 AND line <> ''")
    return lines.select(F.from_csv("line", _CUSTOMERS).alias("c"), "same_bytes").select("c.*", "same_bytes")
