"""Slowly changing dimension, type 2."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import instant, version_key

START_OF_TIME = datetime(1900, 1, 1)
END_OF_TIME = datetime(9999, 12, 31)


def open_versions(current: DataFrame, key: str, as_of: datetime | Column) -> DataFrame:
    """First history of a dimension: every row open since `as_of`."""
    start = instant(as_of)
    return current.select(
        version_key(F.col(key), start).alias("version_key"),
        *current.columns,
        start.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def _refuse(current: DataFrame, history: DataFrame, key: str, start: Column) -> None:
    """A key twice in the source, or a look before an open version began, would corrupt the history."""
    repeated = current.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(5).collect()
    if repeated:
        raise ValueError(f"{key} is not unique in the source, e.g. {[r[0] for r in repeated]}")
    later = history.where(F.col("valid_to").isNull() & (F.col("valid_from") > start)).limit(5).collect()
    if later:
        raise ValueError(f"versions open later than this look, e.g. {key} {[r[key] for r in later]}")


def scd2_apply(
    history: DataFrame,
    current: DataFrame,
    key: str,
    check_columns: Sequence[str],
    as_of: datetime | Column,
) -> DataFrame:
    """History after one more look at the source.

    An unseen key opens a version.  A change in `check_columns` (compared NULL-safe)
    closes the open version at `as_of` and opens another from the same moment.  Other
    columns make no version, and a key absent from `current` stays open.  A key twice in
    `current`, and an `as_of` before the start of an open version, are refused.

    Open versions meet the current rows in one full outer join; each pair then yields
    its one or two versions from an array, so there is no second join and no re-read.
    Closed versions pass by without a shuffle.
    """
    attributes = [c for c in current.columns if c != key]
    start = instant(as_of)
    layout = ["version_key", key, *attributes, "valid_from", "valid_to"]
    if set(layout) != set(history.columns):
        raise ValueError(f"history has {sorted(history.columns)}, the source gives {sorted(layout)}")

    _refuse(current, history, key, start)
    old = history.where(F.col("valid_to").isNull()).select(F.struct(*layout).alias("old"))
    new = current.select(F.struct(key, *attributes).alias("new"))
    pairs = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")

    changed = reduce(or_, [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check_columns])
    unseen = F.col("old").isNull()
    superseded = F.col("old").isNotNull() & F.col("new").isNotNull() & changed

    def version(side: str, key_value: Column, valid_from: Column, valid_to: Column) -> Column:
        return F.struct(
            key_value.alias("version_key"),
            *[F.col(f"{side}.{c}").alias(c) for c in (key, *attributes)],
            valid_from.alias("valid_from"),
            valid_to.alias("valid_to"),
        )

    never = F.lit(None).cast("timestamp")
    opened = version("new", version_key(F.col(f"new.{key}"), start), start, never)
    kept = version("old", F.col("old.version_key"), F.col("old.valid_from"), never)
    closed = version("old", F.col("old.version_key"), F.col("old.valid_from"), start)

    versions = pairs.select(
        F.inline(
            F.when(unseen, F.array(opened)).when(superseded, F.array(closed, opened)).otherwise(F.array(kept))
        )
    )
    return history.where(F.col("valid_to").isNotNull()).select(*layout).unionByName(versions)


def present_dimension(history: DataFrame, key: str, surrogate: str, from_start: bool = False) -> DataFrame:
    """Validity window without NULLs and a flag for the open version.

    A member's first version begins when it was first looked at; `from_start` lets it
    begin at the start of time, so that facts from before that look find it too.
    """
    attributes = [c for c in history.columns if c not in ("version_key", key, "valid_from", "valid_to")]
    if from_start:
        first = history.groupBy(F.col(key).alias("__key")).agg(F.min("valid_from").alias("__first"))
        begins = F.when(F.col("valid_from") == F.col("__first"), instant(START_OF_TIME))
        history = history.join(first, F.col(key) == F.col("__key"), "left").withColumn(
            "valid_from", begins.otherwise(F.col("valid_from"))
        )
    return history.select(
        F.col("version_key").alias(surrogate),
        key,
        *attributes,
        "valid_from",
        F.coalesce(F.col("valid_to"), instant(END_OF_TIME)).alias("valid_to"),
        F.col("valid_to").isNull().alias("is_current"),
    )
