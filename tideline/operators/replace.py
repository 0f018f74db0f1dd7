"""Whole-table replacement of a reference table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import instant
from tideline.operators.quality import verify_min_rows
from tideline.operators.snapshot import is_snapshot, publish
from tideline.operators.versions import Staged, changed_columns, replace_contents


def stamped(df: DataFrame, sha256: str | None, loaded_at: datetime | None = None) -> DataFrame:
    """Load time and the first 16 digits of the source's hash on every row."""
    moment = instant(loaded_at) if loaded_at else F.current_timestamp()
    return df.withColumns({"_loaded_at": moment, "_source_sha256": F.lit((sha256 or "unknown")[:16])})


def replace_table(
    spark: SparkSession,
    table: str,
    df: DataFrame,
    sha256: str | None = None,
    loaded_at: datetime | None = None,
    min_rows: int = 0,
) -> Staged:
    """Give `table` the rows and columns of `df`, stamped.

    Rows are written beside the old ones and the table is switched in one statement; with fewer
    than `min_rows` written it is not switched.  With other columns than before, the name becomes one over snapshots
    (see `snapshot`), and stays one.  The
    hash is provenance: without one the rows read `unknown` and the load goes on.
    """
    rows = stamped(df, sha256, loaded_at)
    changes = spark.catalog.tableExists(table) and (is_snapshot(spark, table) or changed_columns(spark, table, rows.schema))
    return (publish if changes else replace_contents)(spark, table, rows, verify=lambda written: verify_min_rows(written, min_rows))
