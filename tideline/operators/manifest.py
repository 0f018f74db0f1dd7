"""State of what was ingested: one row per key, as a frame and stored in numbered commits."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.frames import small_frame


def update_manifest(manifest: DataFrame, results: DataFrame, key: str = "key") -> DataFrame:
    """Results replace entries of the same key; other entries stay."""
    return manifest.join(results.select(key), key, "left_anti").unionByName(results)


def to_json_lines(manifest: DataFrame, key: str = "key") -> DataFrame:
    """(key, JSON entry) rows, for exchange with tools that keep the manifest as JSON."""
    return manifest.select(key, F.to_json(F.struct(*sorted(manifest.columns))).alias("entry"))


def from_json_lines(lines: DataFrame, schema: str) -> DataFrame:
    return lines.select(F.from_json("entry", schema).alias("e")).select("e.*")


@dataclass(frozen=True)
class StoredManifest:
    """A manifest in a folder: numbered commits, of which each adds or replaces entries.

    A commit first writes its entries under a name of its own, then puts the file of the next number, which names
    them, if it is absent: creation without overwriting, which the file system does for one writer only.  So of
    writers that read the same state one wins; the others are told and read again.  Nothing is
    visible before its numbered file.
    """

    spark: SparkSession
    folder: str
    schema: str

    def _place(self, *parts: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        path = hadoop.Path("/".join([self.folder, *parts]))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The number of the last commit, 0 before the first."""
        path, system = self._place("commits")
        if not system.exists(path):
            return 0
        return max((int(f.getPath().getName()) for f in system.listStatus(path)), default=0)

    def entries(self, version: int | None = None) -> DataFrame:
        """The newest entry of each key, as of a version."""
        struct = T.StructType.fromDDL(self.schema)
        version = self.version() if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], struct)
        number = F.regexp_extract("_metadata.file_path", r"/(\d+)$", 1).cast("long")
        commits = self.spark.read.schema("folder string").text(f"{self.folder}/commits").select(number.alias("__number"), F.col("folder").alias("__folder"))
        named = commits.where(F.col("__number") <= version).collect()  # a commit whose writer died before its content counts for nothing
        if not named:
            return self.spark.createDataFrame([], struct)
        folder = F.regexp_extract("_metadata.file_path", r"/entries/([^/]+)/", 1)
        rows = self.spark.read.schema(struct).parquet(*[f"{self.folder}/entries/{r['__folder']}" for r in named])
        rows = rows.withColumn("__folder", folder).join(small_frame(self.spark, named, "__number bigint, __folder string"), "__folder")
        newest = rows.groupBy("key").agg(F.max(F.struct("__number", *[c for c in struct.names if c != "key"])).alias("e"))
        return newest.select(*[F.col("key") if c == "key" else F.col(f"e.{c}").alias(c) for c in struct.names])

    def commit(self, rows: DataFrame, expected: int) -> bool:
        """Add entries as the commit after `expected`; False, and nothing done, if that number is taken."""
        folder = uuid.uuid4().hex
        rows.select(*T.StructType.fromDDL(self.schema).names).coalesce(1).write.parquet(f"{self.folder}/entries/{folder}")
        return self._put(expected + 1, folder)

    def _put(self, number: int, content: str) -> bool:
        """Put-if-absent of a numbered file; its few bytes are one write, and without them the number is void."""
        path, system = self._place("commits", f"{number:012d}")
        system.mkdirs(path.getParent())
        try:
            out = system.create(path, False)
        except Exception as error:
            if "AlreadyExists" in str(error) or system.exists(path):
                return False
            raise
        out.write(bytearray(content.encode()))
        out.close()
        return True

    def update(self, rows: DataFrame) -> int:
        """Add entries after whatever is there, for writers whose keys are their own; the new version."""
        while True:
            version = self.version()
            if self.commit(rows, version):
                return version + 1
