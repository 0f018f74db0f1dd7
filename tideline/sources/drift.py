"""Schemas of many files: fingerprints, drift and one schema that fits them all."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FOOTER = "path string, columns array<string>, spark_schema string"
_INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_FILES_PER_TASK = 64


def _footer_reader():
    """The task's function, defined here so that it travels by value: workers need not have this package."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSystem
        from pyspark.sql.pandas.types import from_arrow_schema

        for batch in batches:
            paths, names, schemas = batch.column("path").to_pylist(), [], []
            for path in paths:
                uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and path[6] != "/" else path
                system, name = FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
                schema = pq.read_schema(name, filesystem=system)
                names.append(list(schema.names))
                schemas.append(from_arrow_schema(schema, prefer_timestamp_ntz=True).json())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(paths, pa.string()),
                    pa.array(names, pa.list_(pa.string())),
                    pa.array(schemas, pa.string()),
                ],
                ["path", "columns", "spark_schema"],
            )

    return read


def schema_hash(columns: str) -> Column:
    """First 16 hex digits of the sha256 of the comma-joined, sorted column names."""
    return F.substring(F.sha2(F.concat_ws(",", F.array_sort(columns)), 256), 1, 16)


def schema_fingerprints(files: DataFrame, file_count: int | None = None) -> DataFrame:
    """Column names and schema hash of each Parquet file in `files` (column `path`).

    Footers only, read in parallel tasks.  `schema_hash` knows names and not their order;
    `type_hash` also sees a changed type.
    """
    count = files.count() if file_count is None else file_count
    spread = files.select("path").repartition(max(1, -(-count // _FILES_PER_TASK)))
    footers = spread.mapInArrow(_footer_reader(), _FOOTER)
    fields = F.from_json("spark_schema", "fields array<struct<name string, type string>>").getField("fields")
    typed = F.array_sort(F.transform(fields, lambda f: F.concat(f["name"], F.lit(":"), f["type"])))
    return footers.select(
        "path",
        F.array_sort("columns").alias("columns"),
        schema_hash("columns").alias("schema_hash"),
        F.substring(F.sha2(F.concat_ws(",", typed), 256), 1, 16).alias("type_hash"),
        "spark_schema",
    )


def schema_drift(fingerprints: DataFrame, history: DataFrame) -> DataFrame:
    """Fingerprints not seen before in a dataset that has a history.

    A dataset without history has no baseline and is not reported.  This informs; it
    does not fail a load.
    """
    known = history.select("dataset", "schema_hash").distinct()
    return fingerprints.join(known, ["dataset", "schema_hash"], "left_anti").join(
        known.select("dataset").distinct(), "dataset", "left_semi"
    )


def shapes_of(fingerprints: DataFrame) -> list[T.StructType]:
    """The distinct schemas; as many as there are shapes, however many files there are."""
    rows = fingerprints.select("spark_schema").distinct().orderBy("spark_schema").collect()
    return [T.StructType.fromJson(json.loads(r.spark_schema)) for r in rows]


def widen_type(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """Smallest type that holds both without loss, or None."""
    if left == right:
        return left
    if left in _INTEGERS and right in _INTEGERS:
        return max(left, right, key=_INTEGERS.index)
    floats = (T.FloatType(), T.DoubleType())
    if left in floats and right in floats:
        return T.DoubleType()
    small = _INTEGERS[:3]
    if (left in small and right == T.DoubleType()) or (right in small and left == T.DoubleType()):
        return T.DoubleType()
    return None


def widen_schemas(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns of all schemas, each of a type that every file's values fit."""
    merged: dict[str, T.StructField] = {}
    for field in (f for schema in schemas for f in schema):
        name = field.name.lower()
        known = merged.get(name)
        data_type = widen_type(known.dataType, field.dataType) if known else field.dataType
        if data_type is None:
            raise ValueError(
                f"{field.name}: no lossless type for {known.dataType.simpleString()} "
                f"and {field.dataType.simpleString()}"
            )
        merged[name] = T.StructField(known.name if known else field.name, data_type, True)
    return T.StructType(list(merged.values()))


def read_evolving(
    spark: SparkSession, files: DataFrame, base_path: str, partition_by: Iterable[str] = ("period",)
) -> DataFrame:
    """One scan over Parquet files whose schemas grew or widened over time."""
    schema = widen_schemas(shapes_of(schema_fingerprints(files)))
    keyed = T.StructType([*schema, *[T.StructField(c, T.StringType()) for c in partition_by]])
    paths = [r.path for r in files.select("path").collect()]
    return spark.read.schema(keyed).option("basePath", base_path).parquet(*paths)
