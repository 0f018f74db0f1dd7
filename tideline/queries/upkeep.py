"""Compaction, expiry of old versions, and governance metadata."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.frames import small_frame
from tideline.operators.fold import expire_folded, fold_batches, partition_sizes
from tideline.operators.governance import apply_governance, describe_governance
from tideline.operators.ingest import committed, copy_into, rows_per_loaded_period
from tideline.operators.maintain import TARGET_BYTES, compact, describe_detail, expire_versions
from tideline.operators.versions import new_version, replace_contents, stage, switch_partitions, create_table, staged_partitions
from tideline.plans.runs import upkeep
from tideline.queries.feeds import table
from tideline.queries.incremental import lines, new_table
from tideline.queries.landing import LINES, LOADED_AT, land
from tideline.queries.landing import lines as periods
from tideline.queries.registry import query
from tideline.session import workspace


@query(
    """
    SELECT strftime(l_shipdate, '%Y-%m') AS source_period, count(*) AS row_count, CAST(sum(l_suppkey) AS BIGINT) AS vendor_sum,
           true AS few_files, 0 AS rewritten_again
    FROM lineitem GROUP BY 1
    """
)
def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months written as several small files each; afterwards one per month, with the same rows."""
    target = new_table(spark, "compact")
    rows = lines(spark, sf_dir, 1)
    version = new_version(spark, target)
    staged = stage(rows.repartition(4), f"{version}/rows", ["source_period"], spread=False)
    create_table(spark, target, rows.schema, ["source_period"])
    switch_partitions(spark, target, version, staged_partitions(spark, staged.path, rows.schema, ["source_period"]))
    compact(spark, target, "source_period")
    again = compact(spark, target, "source_period")
    stored = spark.table(target)
    counts = stored.groupBy("source_period").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("vendor_id").cast("bigint").alias("vendor_sum")
    )
    needed = F.greatest(F.lit(1), F.ceil(F.col("size_in_bytes") / TARGET_BYTES))
    detail = describe_detail(stored, ["source_period"])
    few = detail.select("source_period", (F.col("num_files") <= needed).alias("few_files"))
    return counts.join(few, "source_period").withColumn("rewritten_again", F.lit(again))


@query(
    """
    SELECT 'cluster' AS kind, count(*) AS row_count, 1 AS rewritten, 1 AS files, 0 AS rewritten_again FROM orders
    UNION ALL SELECT 'period', count(*), 5, 5, 0 FROM orders
    """
)
def upkeep_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables in small files, whole and by priority, brought into shape by one run; the next one does nothing."""
    orders = table(spark, sf_dir, "orders")
    tables = {name: new_table(spark, name) for name in ("cluster", "period")}
    replace_contents(spark, tables["cluster"], orders.repartition(6))
    replace_contents(spark, tables["period"], orders.repartition(3), ["o_orderpriority"], spread=False)
    columns = {t: "o_orderdate" for t in tables.values()}
    first, second = upkeep(spark, columns).collect(), upkeep(spark, columns).collect()
    results = [
        spark.table(t).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("kind"), "row_count", F.lit(a.partitions_rewritten).alias("rewritten"),
            F.lit(b.num_files).cast("int").alias("files"), F.lit(b.partitions_rewritten).alias("rewritten_again"),
        )
        for (name, t), a, b in zip(tables.items(), first, second, strict=True)
    ]
    return results[0].unionByName(results[1])


@query(f"SELECT {', '.join(LINES)}, strftime(l_shipdate, '%Y-%m') AS period FROM lineitem")
def compaction_unpartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in many files, rewritten in the order of its period."""
    target = new_table(spark, "cluster")
    replace_contents(spark, target, periods(spark, sf_dir).repartition(16))
    compact(spark, target, "period")
    return spark.table(target)


@query(
    """
    SELECT c_mktsegment AS segment, count(*) AS customers, 0 AS deleted_at_once, 1 AS deleted_later
    FROM customer GROUP BY c_mktsegment
    """
)
def version_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replaced version outlives the first clean-up and goes a week later; the rows stay."""
    target = new_table(spark, "expiry")
    for _ in range(2):
        replace_contents(spark, target, table(spark, sf_dir, "customer"))
    now = datetime.now(timezone.utc)
    early = expire_versions(spark, target, now=now)
    late = expire_versions(spark, target, now=now + timedelta(days=8))
    counts = spark.table(target).groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("customers"))
    return counts.withColumns({"deleted_at_once": F.lit(len(early)), "deleted_later": F.lit(len(late))})


@query(
    """
    SELECT 'tag' AS kind, 'dataOwner' AS name, 'ORDERS' AS value
    UNION ALL SELECT 'tag', 'rowsAtCreation', CAST(count(*) AS VARCHAR) FROM supplier
    UNION ALL SELECT 'column', 's_suppkey', 'key of the vendor''s record'
    """
)
def governance_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_table(spark, "governed")
    staged = replace_contents(spark, target, table(spark, sf_dir, "supplier"))
    tags = {"dataOwner": "ORDERS", "rowsAtCreation": str(staged.rows)}
    apply_governance(spark, target, tags, "Vendors of orders", {"s_suppkey": "key of the vendor's record"})
    return describe_governance(spark, target)


@query(
    """
    SELECT strftime(l_shipdate, '%Y') AS period, count(*) AS row_count, CAST(sum(l_linenumber) AS BIGINT) AS line_sum,
           10 AS files_before, 1 AS files_after, count(*) AS counted, 0 AS folded_again
    FROM lineitem GROUP BY 1
    """
)
def folded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every year arrives in ten loads; folded, each is one file with the same rows, and a second fold does nothing."""
    folder, raw = workspace(spark, "landing"), new_table(spark, "folded")
    rows = periods(spark, sf_dir).withColumn("period", F.substring("period", 1, 4)).withColumn("tenth", F.pmod("l_orderkey", F.lit(10)))
    rows.repartition("tenth", "period").write.partitionBy("tenth", "period").parquet(folder)
    for tenth in range(10):
        copy_into(spark, raw, f"{folder}/tenth={tenth}", loaded_at=LOADED_AT, actor="loader")
    before = partition_sizes(spark, raw).groupBy("partition").agg(F.sum("files").cast("int").alias("files_before"))
    before = small_frame(spark, before.collect(), before.schema)  # a row per year, before the fold
    fold_batches(spark, raw, "l_shipdate")
    again = fold_batches(spark, raw, "l_shipdate")
    expire_folded(spark, raw, retain_days=0)
    after = partition_sizes(spark, raw).groupBy("partition").agg(F.sum("files").cast("int").alias("files_after"))
    files = before.join(after, "partition").withColumn("period", F.regexp_extract("partition", "period=(.*)", 1)).drop("partition")
    counts = committed(spark, raw).groupBy("period").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("l_linenumber").cast("bigint").alias("line_sum")
    )
    stated = rows_per_loaded_period(spark, raw).withColumnRenamed("row_count", "counted")
    return counts.join(files, "period").join(stated, "period").withColumn("folded_again", F.lit(again))
