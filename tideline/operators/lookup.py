"""Left lookups that never lose a row of the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions import label_or_unknown


def left_lookup(
    fact: DataFrame,
    lookup: DataFrame,
    fact_key: str,
    lookup_key: str,
    values: dict[str, str],
    salt_by: str | None = None,
    salts: int = 16,
) -> DataFrame:
    """LEFT equi join adding `values` ({lookup column: output column}).

    `lookup_key` must be unique in `lookup`.  No size is assumed: a lookup read from
    files is broadcast by Spark below its threshold and otherwise joined by shuffle with
    runtime skew splitting.  `salt_by` names a high-cardinality fact column to spread a
    hot key by hand: each lookup row is repeated `salts` times, each fact row meets one.
    """
    key_name = f"__{fact_key}_key"
    side = lookup.select(
        F.col(lookup_key).alias(key_name), *[F.col(c).alias(out) for c, out in values.items()]
    )
    condition = F.col(fact_key) == F.col(key_name)
    if salt_by is None:
        return fact.join(side, condition, "left").drop(key_name)
    salt, side_salt = f"__{fact_key}_salt", f"__{fact_key}_side_salt"
    fact = fact.withColumn(salt, F.pmod(F.xxhash64(F.col(salt_by)), F.lit(salts)).cast("int"))
    side = side.withColumn(side_salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = fact.join(side, condition & (F.col(salt) == F.col(side_salt)), "left")
    return joined.drop(key_name, salt, side_salt)


def lookup_with_fallback(
    fact: DataFrame,
    lookup: DataFrame,
    fact_key: str,
    lookup_key: str,
    value: str,
    output: str,
    label: str,
    flag: str | None = None,
    salt_by: str | None = None,
) -> DataFrame:
    """Description of a code; a miss reads `Unknown <label> (<code>)`.

    `flag` adds a boolean that is true for codes without a description.
    """
    found = f"__{output}"
    joined = left_lookup(fact, lookup, fact_key, lookup_key, {value: found}, salt_by)
    added: dict[str, Column] = {output: label_or_unknown(F.col(found), label, F.col(fact_key))}
    if flag:
        added[flag] = F.col(found).isNull()
    return joined.withColumns(added).drop(found)


def current_versions(dimension: DataFrame) -> DataFrame:
    """The open version of each member, for joins that want today's name."""
    return dimension.where("is_current")


def point_in_time_join(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    moment: str,
    values: dict[str, str],
) -> DataFrame:
    """LEFT join to the version valid at `moment`, within [valid_from, valid_to).

    Half open, so a moment on a boundary meets one version and the row count holds.  The
    equi part carries the join; the range is checked on the few versions of that key.
    """
    key, start, end = f"__{fact_key}_pit", "__pit_from", "__pit_to"
    side = dimension.select(
        F.col(dimension_key).alias(key),
        F.col("valid_from").alias(start),
        F.col("valid_to").alias(end),
        *[F.col(c).alias(out) for c, out in values.items()],
    )
    condition = (F.col(fact_key) == F.col(key)) & (F.col(moment) >= F.col(start)) & (F.col(moment) < F.col(end))
    return fact.join(side, condition, "left").drop(key, start, end)


ROWS_PER_GROUP = 1_000_000


def as_of_join(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    moment: str,
    values: dict[str, str],
    rows_per_group: int = ROWS_PER_GROUP,
) -> DataFrame:
    """As `point_in_time_join`, for keys with many versions.

    A join on the key would pair each fact with all versions of its key before the range is checked.  Here facts and
    versions are put in one order of time per key, and each fact takes the version last passed, if it has not
    ended: rows are sorted, never multiplied.  A key with more than `rows_per_group` facts is dealt to
    several groups, each of which gets the versions of the key, so no key is sorted in one task.
    The validities of a key must not overlap; of equal openings the one that ends last counts.
    A fact without key or moment, or before the first version, has NULL values.
    """
    version = F.struct(F.col("valid_from"), F.col("valid_to"), *[F.col(c).alias(out) for c, out in values.items()])
    counts = fact.groupBy(F.col(fact_key).alias("__key")).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > rows_per_group) & F.col("__key").isNotNull())
    hot = counts.select("__key", F.ceil(F.col("n") / rows_per_group).cast("int").alias("__groups"))
    row = F.struct(*[F.col(f"`{c}`") for c in fact.columns])
    at = F.col(moment).cast("timestamp") if dict(fact.dtypes)[moment] != dict(dimension.dtypes)["valid_from"] else F.col(moment)
    facts = fact.select(row.alias("__row"), F.col(fact_key).alias("__key"), at.alias("__at"))
    facts = facts.withColumn("__n", F.monotonically_increasing_id()).join(hot, "__key", "left").select(
        "__row", "__key", "__at", F.when(F.col("__key").isNull(), F.pmod("__n", F.lit(100_003))).when(F.col("__groups").isNotNull(), F.pmod("__n", "__groups"))
        .otherwise(0).cast("int").alias("__group"),
    )
    versions = dimension.select(F.col(dimension_key).alias("__key"), F.col("valid_from").alias("__at"), version.alias("__version"))
    versions = versions.join(hot, "__key", "left").withColumn(
        "__group", F.explode(F.sequence(F.lit(0), F.coalesce("__groups", F.lit(1)) - 1))
    ).drop("__groups")
    events = facts.unionByName(versions, allowMissingColumns=True)
    is_fact = F.col("__row").isNotNull()
    passed = Window.partitionBy("__key", "__group").orderBy("__at", is_fact, F.col("__version.valid_to")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = events.withColumn("__found", F.last("__version", ignorenulls=True).over(passed)).where(is_fact)
    holds = F.col("__key").isNotNull() & (F.col("__at") < F.col("__found.valid_to"))
    return found.select(
        *[F.col("__row").getField(c).alias(c) for c in fact.columns],
        *[F.when(holds, F.col("__found").getField(out)).alias(out) for out in values.values()],
    )
