"""Taxi trips: two raw feeds to one conformed shape, a vendor dimension and a fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import duration_minutes, instant, is_sentinel, local_parts
from tideline.operators.aggregate import combine_observations, observe_keys
from tideline.operators.conform import Field, conform, union_feeds
from tideline.operators.contract import Contract, ContractColumn
from tideline.operators.governance import apply_governance
from tideline.operators.ingest import create_like
from tideline.operators.lookup import current_versions, lookup_with_fallback
from tideline.operators.versions import quoted

# --- fixed values: feed names, zone, reserved zones, published code lists -----------------
ZONE = "America/New_York"
UNKNOWN_ZONES = (264, 265)
FIRST_PERIOD = "1900-01"
YELLOW, GREEN = "Yellow Taxi", "Green Taxi"
ZONE_HEADER = ("LocationID", "Borough", "Zone", "service_zone")
VENDORS = {
    1: "Creative Mobile Technologies LLC",
    2: "Curb Mobility LLC",
    6: "Myle Technologies Inc",
    7: "Helix",
}
RATE_CODES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
    99: "Null/unknown",
}
PAYMENT_TYPES = {
    0: "Flex Fare trip",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
TRIP_TYPES = {1: "Street-hail", 2: "Dispatch"}
# ------------------------------------------------------------------------------------------


# Tags of the tables.
_TAGS = {
    "datasetVersion": "1.0.0",
    "contractStatus": "ACTIVE",
    "criticality": "MODERATE",
    "recoverySla": "2_BUSINESS_DAYS",
    "informationClassification": "PUBLIC",
    "complianceClassification": "NONE",
    "dataDurationClassification": "PERMANENT",
    "updateType": "AUTOMATIC",
    "legalHold": "NO",
    "dataPrimacy": "REPLICA",
}
_RELEASE_TAGS = ("datasetVersion", "contractStatus", "criticality", "recoverySla")
RAW_TAGS = {key: value for key, value in _TAGS.items() if key not in _RELEASE_TAGS}


def _columns(text: str) -> tuple[ContractColumn, ...]:
    """Lines of `name type [!] [# comment]`; `!` marks a column that must not be NULL."""
    columns = []
    for line in text.strip().splitlines():
        declared, _, comment = line.partition("#")
        name, type_, *flags = declared.split()
        columns.append(ContractColumn(name, type_, "!" in flags, comment.strip()))
    return tuple(columns)


_RAW_COMMON = """
    vendorid              int           # provider of the record
    pickup                timestamp_ntz # wall clock, meter on
    dropoff               timestamp_ntz # wall clock, meter off
    passenger_count       bigint        # entered by the driver
    trip_distance         double        # miles
    ratecodeid            bigint
    store_and_fwd_flag    string        # Y if held in the vehicle before sending
    pulocationid          int           # zone
    dolocationid          int           # zone
    payment_type          bigint
    fare_amount           double
    extra                 double
    mta_tax               double
    tip_amount            double        # cards only
    tolls_amount          double
    improvement_surcharge double
    total_amount          double        # without cash tips
    congestion_surcharge  double
"""
_RAW_OWN = {
    "tpep": """
    airport_fee           double        # pick-ups at airports
""",
    "lpep": """
    ehail_fee             double
    trip_type             bigint        # street-hail or dispatch
    cbd_congestion_fee    double
""",
}


def raw_schema(clock_prefix: str) -> T.StructType:
    """Columns of a raw feed (`tpep` yellow, `lpep` green) for a table made before its first load."""
    declared = _columns(_RAW_COMMON.strip() + "\n" + _RAW_OWN[clock_prefix].strip())
    names = {moment: f"{clock_prefix}_{moment}_datetime" for moment in ("pickup", "dropoff")}
    fields = [(names.get(c.name, c.name), c.type, c.comment) for c in declared]
    schema = T.StructType()
    for name, type_, text in fields:
        schema.add(name, T.DataType.fromDDL(type_), True, {"comment": text} if text else None)
    return schema


def create_raw_table(spark: SparkSession, table: str, clock_prefix: str) -> None:
    """Empty raw table of a feed with lineage columns, comments and tags."""
    create_like(spark, table, raw_schema(clock_prefix))
    apply_governance(spark, table, RAW_TAGS, "Trips as landed; append-only")


SEEDS = {
    "vendor_lookup": "vendor_id bigint, vendor_name string",
    "rate_code_lookup": "rate_code_id bigint, rate_code_description string",
    "payment_type_lookup": "payment_type bigint, payment_type_description string",
    "trip_type_lookup": "trip_type bigint, trip_type_description string",
}


def code_list(spark: SparkSession, values: dict[int, str], key: str, value: str) -> DataFrame:
    """A code list as rows.  Literal rows, so Spark knows their size and broadcasts them."""
    rows = ", ".join(f"({code}L, {quoted(text)})" for code, text in values.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS codes({key}, {value})")


def trip_fields(feed: str, label: str, clock_prefix: str) -> list[Field]:
    """The shared trip shape as one feed fills it.

    Yellow has an airport fee; green has a trip type and an e-hail fee.  The other feed
    carries those as typed NULLs.  The congestion zone fee came late and counts as 0
    where absent, so that sums over it stay sums.
    """
    green = label == GREEN
    pickup, dropoff = f"{clock_prefix}_pickup_datetime", f"{clock_prefix}_dropoff_datetime"
    key = (
        F.lit(feed), "vendorid", pickup, dropoff, "pulocationid", "dolocationid",
        "passenger_count", "trip_distance", "total_amount",
    )
    return [
        Field("trip_key", "string", key_of=key),
        Field("tlc_type", "string", value=label),
        Field("vendor_id", "bigint", "vendorid"),
        Field("rate_code_id", "bigint", "ratecodeid"),
        Field("payment_type", "bigint", "payment_type"),
        Field("pickup_location_id", "bigint", "pulocationid"),
        Field("dropoff_location_id", "bigint", "dolocationid"),
        Field("trip_type", "bigint", "trip_type" if green else None),
        Field("pickup_at", "timestamp", pickup, zone=ZONE),
        Field("dropoff_at", "timestamp", dropoff, zone=ZONE),
        Field("pickup_at_local", "timestamp_ntz", pickup),
        Field("dropoff_at_local", "timestamp_ntz", dropoff),
        Field("passenger_count", "bigint", "passenger_count"),
        Field("trip_distance_miles", "double", "trip_distance"),
        Field("fare_amount", "double", "fare_amount"),
        Field("extra_amount", "double", "extra"),
        Field("mta_tax_amount", "double", "mta_tax"),
        Field("tip_amount", "double", "tip_amount"),
        Field("tolls_amount", "double", "tolls_amount"),
        Field("improvement_surcharge", "double", "improvement_surcharge"),
        Field("congestion_surcharge", "double", "congestion_surcharge"),
        Field("total_amount", "double", "total_amount"),
        Field("airport_fee", "double", None if green else "airport_fee"),
        Field("ehail_fee", "double", "ehail_fee" if green else None),
        Field("cbd_congestion_fee", "double", "cbd_congestion_fee", default=0),
        Field("store_and_forward_flag", "string", "store_and_fwd_flag"),
        Field("source_period", "string", "period"),
        Field("source_file", "string", "_loaded_from"),
        Field("loaded_at", "timestamp", "_loaded_at"),
    ]


def yellow_trips(raw: DataFrame) -> DataFrame:
    return conform(raw, trip_fields("yellow", YELLOW, "tpep"))


def green_trips(raw: DataFrame) -> DataFrame:
    return conform(raw, trip_fields("green", GREEN, "lpep"))


def all_trips(raw_yellow: DataFrame, raw_green: DataFrame) -> DataFrame:
    return union_feeds([yellow_trips(raw_yellow), green_trips(raw_green)])


def zone_reference(zones: DataFrame, sentinels: tuple[int, ...] = UNKNOWN_ZONES) -> DataFrame:
    """Zones with the reserved ones flagged; trips do carry them, so they stay."""
    return zones.select(
        F.col("locationid").cast("bigint").alias("location_id"),
        "borough",
        F.col("zone").alias("zone_name"),
        "service_zone",
        is_sentinel(F.col("locationid"), sentinels).alias("is_unknown_zone"),
        F.col("_loaded_at").alias("loaded_at"),
    )


def observed_vendors(trips: DataFrame, vendors: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Every vendor met in trips, named by the lookup or by a placeholder.

    With the stored observations of `earlier` runs, `trips` need only hold what is new.
    """
    observed = observe_keys(trips.select("vendor_id", "pickup_at"), "vendor_id", "pickup_at")
    if earlier is not None:
        observed = combine_observations(earlier.select(*observed.columns), observed, "vendor_id")
    return named_vendors(observed, vendors)


def named_vendors(observed: DataFrame, vendors: DataFrame) -> DataFrame:
    """Observations with the vendor's name, or a placeholder."""
    named = lookup_with_fallback(
        observed, vendors, "vendor_id", "vendor_id", "vendor_name", "vendor_name", "vendor", flag="is_unmapped"
    )
    return named.select("vendor_id", "vendor_name", "is_unmapped", "first_seen_at", "last_seen_at", "trip_count")


def trip_fact(
    trips: DataFrame,
    vendor_dimension: DataFrame,
    rate_codes: DataFrame,
    payment_types: DataFrame,
    trip_types: DataFrame,
    updated_at: datetime | None = None,
    updated_by: str | None = None,
) -> DataFrame:
    """One row per trip with descriptions, local time attributes and duration.

    Only lookups by left join: an outdated list labels trips, it never loses them.  The
    joins keep the partitioning of `trips`, so the fact is built without a shuffle as long
    as the lookups are below Spark's broadcast threshold.
    """
    vendors = current_versions(vendor_dimension)
    lookups = [
        (vendors, "vendor_id", "vendor_name", "vendor"),
        (rate_codes, "rate_code_id", "rate_code_description", "rate code"),
        (payment_types, "payment_type", "payment_type_description", "payment type"),
        (trip_types, "trip_type", "trip_type_description", "trip type"),
    ]
    rows = trips
    for lookup, key, description, label in lookups:
        rows = lookup_with_fallback(rows, lookup, key, key, description, description, label)
    clock = local_parts(F.col("pickup_at_local"))
    rows = rows.withColumns(
        {
            **{f"pickup_{name}": column for name, column in clock.items()},
            "trip_duration_minutes": duration_minutes(F.col("pickup_at"), F.col("dropoff_at")),
            "updated_at": instant(updated_at) if updated_at else F.current_timestamp(),
            "updated_by": F.lit(updated_by) if updated_by else F.current_user(),
        }
    )
    return rows.select(*TRIP_CONTRACT.types)


# Names, types and required columns of the published tables.
VENDOR_CONTRACT = Contract(
    _columns(
        """
        vendor_key   string    ! # one per version
        vendor_id    bigint    ! # one per vendor, repeated in each of its versions
        vendor_name  string    ! # from the lookup, or a placeholder
        is_unmapped  boolean   ! # the lookup has no name: add one
        valid_from   timestamp !
        valid_to     timestamp ! # 9999-12-31 while open
        is_current   boolean   ! # exactly one per vendor
        """
    ),
    comment="Vendors with their history; one row per vendor and version.",
    tags=_TAGS,
)

TRIP_CONTRACT = Contract(
    _columns(
        """
        trip_key                 string        ! # unique; the merge key
        tlc_type                 string        ! # feed of the trip
        vendor_id                bigint
        vendor_name              string        ! # today's name
        rate_code_id             bigint
        rate_code_description    string        !
        payment_type             bigint
        payment_type_description string        !
        trip_type                bigint          # green only
        trip_type_description    string          # green only
        pickup_location_id       bigint          # may be a reserved zone
        dropoff_location_id      bigint          # may be a reserved zone
        pickup_at                timestamp       # instant
        dropoff_at               timestamp       # instant
        pickup_at_local          timestamp_ntz   # wall clock as recorded
        dropoff_at_local         timestamp_ntz   # wall clock as recorded
        pickup_date              date            # local
        pickup_hour              int             # local, 0 to 23
        pickup_day_of_week       int             # local, Sunday is 1
        trip_duration_minutes    double          # may be negative
        passenger_count          bigint          # may be missing or 0
        trip_distance_miles      double
        fare_amount              double
        extra_amount             double
        mta_tax_amount           double
        tip_amount               double          # cards only
        tolls_amount             double
        improvement_surcharge    double
        congestion_surcharge     double
        cbd_congestion_fee       double          # 0 where the source has none
        airport_fee              double          # yellow only
        ehail_fee                double          # green only
        total_amount             double          # negative for refunds
        store_and_forward_flag   string
        source_period            string        ! # month of the source file
        source_file              string
        loaded_at                timestamp
        updated_at               timestamp
        updated_by               string
        """
    ),
    comment="Trips of both feeds with descriptions; one row per trip.",
    tags=_TAGS,
)
