"""Files kept byte for byte: contents under their hash, and dated lists of what was where."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

LIST = "path string, sha256 string, length bigint, modified_at timestamp"


@dataclass
class _Stored(WriterCommitMessage):
    files: int


class _Writer(DataSourceWriter):
    """Writes each content to `objects/<sha256>`, under another name first and then moved, so that an object is whole or absent.

    Equal contents meet at one name, from whatever task or attempt."""

    def __init__(self, folder: str):
        self.folder = folder

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.folder)
        system.create_dir(f"{path}/objects", recursive=True)
        n = 0
        for row in iterator:
            target = f"{path}/objects/{row.sha256}"
            if system.get_file_info(target).type == fs.FileType.NotFound:
                draft = f"{target}.{uuid.uuid4().hex[:8]}.part"
                with system.open_output_stream(draft) as out:
                    out.write(bytes(row.content))
                system.move(draft, target)
            n += 1
        return _Stored(n)


class ArchiveSource(DataSource):
    """`df.write.format("tideline_archive").mode("append").save(folder)` for (sha256, content)."""

    @classmethod
    def name(cls) -> str:
        return "tideline_archive"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"])


def archive_files(spark: SparkSession, source: str, folder: str, at: datetime | None = None) -> DataFrame:
    """Keep the files below `source` as they are; (path, sha256, length, modified_at) of each.

    Contents go from the tasks that read them to `objects/`, each distinct one once.  Then the list of this time is
    written to `history/<time>`; without it nothing refers to an object.  Empty files are not listed, as in any scan of
    Spark; `validate_reference` refuses them before.  A file is read as one value, so this is for
    reference files, up to 2 GB each.
    """
    spark.dataSource.register(ArchiveSource)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    hashed = files.withColumn("sha256", F.sha2("content", 256))
    hashed.select("sha256", "content").write.format("tideline_archive").mode("append").save(folder)
    stamp = (at or datetime.now(timezone.utc)).strftime("%Y%m%d%H%M%S")
    listed = hashed.select("path", "sha256", "length", F.col("modificationTime").alias("modified_at"))
    listed.write.parquet(f"{folder}/history/{stamp}")
    return archived(spark, folder, stamp)


def archived(spark: SparkSession, folder: str, stamp: str) -> DataFrame:
    """The list of a time."""
    return spark.read.schema(LIST).parquet(f"{folder}/history/{stamp}")


def contents(spark: SparkSession, folder: str, stamp: str) -> DataFrame:
    """(path, sha256, content) of a time's files, from the objects."""
    objects = spark.read.format("binaryFile").load(f"{folder}/objects").select(
        F.regexp_extract("path", "/([^/]+)$", 1).alias("sha256"), "content"
    )
    return archived(spark, folder, stamp).select("path", "sha256").join(objects, "sha256").select("path", "sha256", "content")
