"""The data tests of the published tables, the feeds and the lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tideline.operators.quality import (
    DataTest,
    accepted_values_test,
    not_null_test,
    relationships_test,
    single_open_version,
    unique_test,
)
from tideline.plans.trips import GREEN, YELLOW


def key_tests(name: str, df: DataFrame, column: str) -> list[DataTest]:
    """A key is present and occurs once."""
    return [unique_test(f"{name}_{column}_unique", df, column), not_null_test(f"{name}_{column}_not_null", df, column)]


def lookup_tests(lookups: dict[str, tuple[DataFrame, str]]) -> list[DataTest]:
    """Key tests of every lookup, given as {name: (rows, key)}."""
    return [test for name, (df, key) in lookups.items() for test in key_tests(name, df, key)]


def feed_tests(yellow: DataFrame, green: DataFrame) -> list[DataTest]:
    tests = []
    for name, df, label in (("yellow", yellow, YELLOW), ("green", green, GREEN)):
        tests.append(not_null_test(f"{name}_pickup_at_not_null", df, "pickup_at"))
        tests.append(accepted_values_test(f"{name}_tlc_type_accepted", df, "tlc_type", [label], warn_if=None))
    return tests


def dimension_tests(dimension: DataFrame) -> list[DataTest]:
    return [
        *key_tests("vendor", dimension, "vendor_key"),
        not_null_test("vendor_id_not_null", dimension, "vendor_id"),
        not_null_test("vendor_name_not_null", dimension, "vendor_name"),
        DataTest("vendor_single_open_version", failing=single_open_version(dimension, "vendor_id")),
    ]


def fact_tests(fact: DataFrame, zones: DataFrame) -> list[DataTest]:
    required = ["tlc_type", "vendor_name", "rate_code_description", "payment_type_description", "pickup_at"]
    return [
        *key_tests("fact", fact, "trip_key"),
        *[not_null_test(f"fact_{column}_not_null", fact, column) for column in required],
        accepted_values_test("fact_tlc_type_accepted", fact, "tlc_type", [YELLOW, GREEN], warn_if=None),
        relationships_test("fact_pickup_zone_known", fact, "pickup_location_id", zones, "location_id"),
    ]
