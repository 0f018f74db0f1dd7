"""Small frames made by the driver: names, counts and states, never data."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def small_frame(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """Rows as literals of the plan: no Python worker, and a size that Spark knows."""
    struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    columns = [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), struct)
