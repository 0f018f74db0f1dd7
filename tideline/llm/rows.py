"""Small helpers that the operators share: Arrow maps, tables in the shared folder, text clean-up."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from tideline.session import workspace

Columns = dict[str, list]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_columns(df: DataFrame, kernel: Callable[[Iterator[Columns]], Iterator[dict]], schema: str, rows: int = 0) -> DataFrame:
    """Run `kernel` over the Arrow batches of each partition, as lists by column name, of `rows` rows at most where given."""
    struct = StructType.fromDDL(schema)

    def run(batches):
        arrow = to_arrow_schema(struct)
        if rows:
            batches = (batch.slice(at, rows) for batch in batches for at in range(0, batch.num_rows, rows))
        columns = (batch.to_pydict() for batch in batches)
        for out in kernel(columns):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, struct)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a new table in the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = workspace(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def identified(docs: DataFrame, *more: str) -> DataFrame:
    """`doc_id` and `text` with a NULL text read as empty; other columns only on request."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def column(name: str) -> Column:
    """The column of just this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, or with a number after it where `df` has such a column already."""
    taken, name, n = {c.lower() for c in df.columns}, wanted, 0
    while name.lower() in taken:
        n += 1
        name = f"{wanted}_{n}"
    return name


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """All columns of `docs` in one struct `whole`, so that no name of theirs meets an inner one; and `more`."""
    return docs.select(F.struct(*[column(c) for c in docs.columns]).alias("whole"), *more)


def unpacked(df: DataFrame, columns: list[str], changed: dict[str, Column] | None = None) -> list[Column]:
    """The columns that `packed` put into `whole`, under their names; `changed` ones by their new value."""
    changed = changed or {}
    return [changed.get(c, F.col("whole").getField(c)).alias(c) for c in columns]


def with_value(docs: DataFrame, of: Callable[[list[str]], list], kind: str) -> DataFrame:
    """(whole, value): `of` gives a value for each text, NULL read as empty.

    Only texts become Python objects; the other columns pass as they come."""
    wide = packed(docs)
    value = StructType.fromDDL(f"value {kind}")["value"]
    struct = StructType([StructField("whole", wide.schema["whole"].dataType), value])

    def run(batches):
        schema = to_arrow_schema(struct)
        for batch in batches:
            whole = batch.column("whole")
            values = of([t or "" for t in whole.field("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([whole.cast(schema.field("whole").type), pa.array(values, type=schema.field("value").type)], schema=schema)

    return wide.mapInArrow(run, struct)
