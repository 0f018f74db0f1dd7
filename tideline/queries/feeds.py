"""The given tables seen as two raw trip feeds.

Order lines stand in for trips: status F is the yellow feed, status O the green one.  The
same mapping is written once as DataFrames and once as SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import period_of
from tideline.plans.trips import ZONE, code_list

RATE_NAMES = {1: "Standard", 2: "Second", 3: "Third", 4: "Fourth", 5: "Fifth"}
PAYMENT_NAMES = {1: "Urgent", 2: "High", 3: "Medium", 4: "Unspecified"}
TYPE_NAMES = {1: "Accepted", 2: "None"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hours(amount: str) -> Column:
    return F.make_dt_interval(F.lit(0), F.col(amount).cast("int") % 24)


def raw_feed(spark: SparkSession, sf_dir: str, status: str, locations: bool = True) -> DataFrame:
    """Raw rows of one feed.  `locations=False` leaves out two joins when zones are not used."""
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == status)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    if locations:  # customers meet the orders, which are fewer and narrower than the lines
        customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if locations:
        suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        rows = rows.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    else:
        rows = rows.withColumns({"s_nationkey": F.lit(None).cast("int"), "c_nationkey": F.lit(None).cast("int")})
    prefix, feed = ("tpep", "yellow") if status == "F" else ("lpep", "green")
    period = period_of(F.col("l_shipdate"))
    columns = {
        "vendorid": F.col("l_suppkey").cast("int"),
        f"{prefix}_pickup_datetime": F.col("o_orderdate") + hours("l_partkey"),
        f"{prefix}_dropoff_datetime": F.col("l_shipdate") + hours("l_suppkey"),
        "passenger_count": F.col("l_quantity").cast("bigint"),
        "trip_distance": F.col("l_quantity"),
        "ratecodeid": F.col("l_linenumber").cast("bigint"),
        "store_and_fwd_flag": F.col("l_returnflag"),
        "pulocationid": F.col("s_nationkey"),
        "dolocationid": F.col("c_nationkey"),
        "payment_type": F.substring("o_orderpriority", 1, 1).cast("bigint"),
        "fare_amount": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "extra": F.col("l_discount"),
        "mta_tax": F.col("l_tax"),
        "tip_amount": F.col("l_extendedprice") * F.col("l_tax"),
        "tolls_amount": F.col("l_linenumber").cast("double"),
        "improvement_surcharge": F.col("l_tax"),
        "total_amount": F.col("l_extendedprice"),
        "congestion_surcharge": F.col("l_discount"),
    }
    if status == "F":
        columns["airport_fee"] = F.col("l_tax")
    else:
        flag = F.col("l_returnflag")
        columns["ehail_fee"] = F.when(flag != "N", F.col("l_discount"))
        columns["trip_type"] = F.when(flag == "A", 1).when(flag == "N", 2).when(flag == "R", 3).cast("bigint")
        columns["cbd_congestion_fee"] = F.when(flag != "A", F.col("l_tax"))
    columns["period"] = period
    columns["_loaded_from"] = F.concat(F.lit(f"landing/dataset={feed}/period="), period)
    columns["_loaded_at"] = (F.col("l_shipdate") + F.expr("INTERVAL 45 DAYS")).cast("timestamp")
    return rows.select(*[c.alias(name) for name, c in columns.items()])


def raw_feeds(spark: SparkSession, sf_dir: str, locations: bool = True) -> tuple[DataFrame, DataFrame]:
    return raw_feed(spark, sf_dir, "F", locations), raw_feed(spark, sf_dir, "O", locations)


def vendor_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier names; every tenth is missing on purpose, so there are unmapped codes."""
    named = table(spark, sf_dir, "supplier").where(F.col("s_suppkey") % 10 != 0)
    return named.select(F.col("s_suppkey").alias("vendor_id"), F.col("s_name").alias("vendor_name"))


def code_lists(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        code_list(spark, RATE_NAMES, "rate_code_id", "rate_code_description"),
        code_list(spark, PAYMENT_NAMES, "payment_type", "payment_type_description"),
        code_list(spark, TYPE_NAMES, "trip_type", "trip_type_description"),
    )


def instant_sql(clock: str) -> str:
    """UTC timestamp of a wall clock; the earlier instant where a time occurs twice."""
    early = f"(timezone('{ZONE}', {clock} - INTERVAL 1 HOUR) + INTERVAL 1 HOUR)"
    return (
        f"timezone('UTC', CASE WHEN timezone('{ZONE}', {early}) = {clock} "
        f"THEN {early} ELSE timezone('{ZONE}', {clock}) END)"
    )


def key_sql(*fields: str) -> str:
    parts = ", ".join(f"coalesce(CAST({f} AS VARCHAR), '_null_')" for f in fields)
    return f"md5(concat_ws('-', {parts}))"


def codes_sql(name: str, values: dict[int, str], key: str, value: str) -> str:
    rows = ", ".join(f"({code}, '{text}')" for code, text in values.items())
    return f"{name}({key}, {value}) AS (VALUES {rows})"


# CTE `raw`: both feeds before conforming; CTE `trips`: the conformed union.
RAW_SQL = """
raw AS (
  SELECT l_linestatus AS status,
         CASE l_linestatus WHEN 'F' THEN 'yellow' ELSE 'green' END AS feed,
         l_suppkey AS vendorid, l_linenumber AS ratecodeid,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS payment_code,
         s_nationkey AS pu, c_nationkey AS dl,
         o_orderdate + to_hours(CAST(l_partkey % 24 AS BIGINT)) AS pickup,
         l_shipdate + to_hours(CAST(l_suppkey % 24 AS BIGINT)) AS dropoff,
         strftime(l_shipdate, '%Y-%m') AS period, lineitem.*
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN customer ON o_custkey = c_custkey
  WHERE l_linestatus IN ('F', 'O')
)"""

TRIPS_SQL = f"""{RAW_SQL},
trips AS (
  SELECT {key_sql("feed", "vendorid", "pickup", "dropoff", "pu", "dl", "CAST(l_quantity AS BIGINT)", "l_quantity", "l_extendedprice")} AS trip_key,
         CASE status WHEN 'F' THEN 'Yellow Taxi' ELSE 'Green Taxi' END AS tlc_type,
         CAST(vendorid AS BIGINT) AS vendor_id, CAST(ratecodeid AS BIGINT) AS rate_code_id,
         payment_code AS payment_type,
         CAST(pu AS BIGINT) AS pickup_location_id, CAST(dl AS BIGINT) AS dropoff_location_id,
         CASE WHEN status = 'O' THEN
           CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS BIGINT) END AS trip_type,
         {instant_sql("pickup")} AS pickup_at, {instant_sql("dropoff")} AS dropoff_at,
         pickup AS pickup_at_local, dropoff AS dropoff_at_local,
         CAST(l_quantity AS BIGINT) AS passenger_count, l_quantity AS trip_distance_miles,
         l_extendedprice * (1 - l_discount) AS fare_amount, l_discount AS extra_amount,
         l_tax AS mta_tax_amount, l_extendedprice * l_tax AS tip_amount,
         CAST(l_linenumber AS DOUBLE) AS tolls_amount, l_tax AS improvement_surcharge,
         l_discount AS congestion_surcharge, l_extendedprice AS total_amount,
         CASE WHEN status = 'F' THEN l_tax END AS airport_fee,
         CASE WHEN status = 'O' AND l_returnflag <> 'N' THEN l_discount END AS ehail_fee,
         CASE WHEN status = 'O' AND l_returnflag <> 'A' THEN l_tax ELSE 0.0::DOUBLE END AS cbd_congestion_fee,
         l_returnflag AS store_and_forward_flag, period AS source_period,
         'landing/dataset=' || feed || '/period=' || period AS source_file,
         l_shipdate + INTERVAL 45 DAY AS loaded_at
  FROM raw
)"""

VENDORS_SQL = "vendors AS (SELECT s_suppkey AS vendor_id, s_name AS vendor_name FROM supplier WHERE s_suppkey % 10 <> 0)"
CODES_SQL = ", ".join(
    [
        codes_sql("rate_codes", RATE_NAMES, "rate_code_id", "rate_code_description"),
        codes_sql("payment_types", PAYMENT_NAMES, "payment_type", "payment_type_description"),
        codes_sql("trip_types", TYPE_NAMES, "trip_type", "trip_type_description"),
    ]
)
