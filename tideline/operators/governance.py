"""Tags and comments on databases, tables and columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.frames import small_frame
from tideline.operators.contract import Contract
from tideline.operators.snapshot import resolve
from tideline.operators.versions import partition_columns, quoted

COLUMN_TAG = "column."


def _pairs(tags: dict[str, str]) -> str:
    return ", ".join(f"{quoted(key)} = {quoted(value)}" for key, value in tags.items())


def tag_database(spark: SparkSession, database: str, tags: dict[str, str], comment: str | None = None) -> None:
    if tags:
        spark.sql(f"ALTER DATABASE {database} SET DBPROPERTIES ({_pairs(tags)})")
    if comment:
        spark.sql(f"COMMENT ON DATABASE {database} IS {quoted(comment)}")


def apply_governance(
    spark: SparkSession,
    table: str,
    tags: dict[str, str] | None = None,
    comment: str | None = None,
    column_comments: dict[str, str] | None = None,
    column_tags: dict[str, dict[str, str]] | None = None,
) -> None:
    """Set tags as table properties, the comments of the table and its columns, and tags of columns.

    Spark has no tags of columns: they are properties `column.<column>.<tag>` of the table.  Of a name that points to
    a snapshot, tags belong to the name and outlive it; comments are those of the snapshot's columns.
    """
    held = resolve(spark, table)
    of_columns = {f"{COLUMN_TAG}{c}.{tag}": value for c, own in (column_tags or {}).items() for tag, value in own.items()}
    known = {c.name for c in spark.catalog.listColumns(held)}
    if unknown := sorted(set(column_tags or {}) - known):
        raise ValueError(f"{table} has no columns {unknown}")
    if all_tags := {**(tags or {}), **of_columns}:
        spark.sql(f"ALTER {'TABLE' if held == table else 'VIEW'} {table} SET TBLPROPERTIES ({_pairs(all_tags)})")
    if comment:
        spark.sql(f"COMMENT ON TABLE {held} IS {quoted(comment)}")
    for column, text in (column_comments or {}).items():
        spark.sql(f"ALTER TABLE {held} ALTER COLUMN `{column}` COMMENT {quoted(text)}")


def apply_contract_governance(spark: SparkSession, table: str, contract: Contract) -> None:
    """The tags and comments that a contract carries.

    Spark sets the comment of a partition column at creation only; `enforce_contract` hands
    it over with the column.
    """
    fixed = partition_columns(spark, resolve(spark, table))
    comments = {c.name: c.comment for c in contract.columns if c.comment and c.name not in fixed}
    apply_governance(spark, table, contract.tags, contract.comment or None, comments)


def describe_governance(spark: SparkSession, table: str) -> DataFrame:
    """(kind, name, value) rows of a table's tags, column comments and column tags (named `column.tag`)."""
    of_column = F.col("key").startswith(COLUMN_TAG)
    tags = spark.sql(f"SHOW TBLPROPERTIES {table}").where(~F.col("key").rlike("^(view\\.|tideline\\.)")).select(
        F.when(of_column, "column tag").otherwise("tag").alias("kind"),
        F.when(of_column, F.substring("key", len(COLUMN_TAG) + 1, 10_000)).otherwise(F.col("key")).alias("name"), "value",
    )
    columns = small_frame(
        spark,
        [("column", c.name, c.description) for c in spark.catalog.listColumns(resolve(spark, table)) if c.description],
        "kind string, name string, value string",
    )
    return tags.unionByName(columns)
