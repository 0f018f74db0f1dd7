"""Declared schemas, checked before a table is published."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.versions import Staged, replace_contents


class SchemaMismatch(ValueError):
    """Columns or types differ from what was declared."""


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str
    required: bool = False
    comment: str = ""


@dataclass(frozen=True)
class Contract:
    columns: tuple[ContractColumn, ...]
    comment: str = ""
    tags: dict[str, str] = field(default_factory=dict)

    @property
    def types(self) -> dict[str, str]:
        return {c.name: c.type for c in self.columns}

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]


def schema_differences(schema: T.StructType, declared: dict[str, str]) -> list[str]:
    """Missing, extra and mistyped columns, by name; the order of columns is free."""
    actual = {f.name: f.dataType.simpleString() for f in schema}
    wanted = {name: T.DataType.fromDDL(type_).simpleString() for name, type_ in declared.items()}
    missing = [f"missing {c}" for c in wanted if c not in actual]
    extra = [f"extra {c}" for c in actual if c not in wanted]
    mistyped = [
        f"{c} is {actual[c]}, declared {wanted[c]}" for c in wanted if c in actual and actual[c] != wanted[c]
    ]
    return missing + extra + mistyped


def enforce_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Fail on any schema difference; the result has the declared column order and comments."""
    differences = schema_differences(df.schema, contract.types)
    if differences:
        raise SchemaMismatch("; ".join(differences))
    return df.select(
        *[F.col(c.name).alias(c.name, metadata={"comment": c.comment} if c.comment else {}) for c in contract.columns]
    )


def null_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """NULLs in required columns, one row per column, from one pass over the data."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in contract.required])
    return counts.unpivot([], contract.required, "column_name", "null_count")


def build_table(
    spark: SparkSession, table: str, df: DataFrame, contract: Contract, partition_by: Sequence[str] = ()
) -> Staged:
    """Publish `df` as the contents of `table` if it keeps the contract.

    Schema first, at no cost.  NULLs are counted while the rows are staged, and the
    table is switched over only if there are none, so the data is read once.
    """
    return replace_contents(spark, table, enforce_contract(df, contract), partition_by, contract.required)
