"""Which periodic files to fetch: the look-back window and change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions import month_anchor, months_back, period_of

# Publication delay and look-back of the source.
LAG_MONTHS = 2
LOOKBACK_MONTHS = 8


def candidate_window(
    runs: DataFrame,
    datasets: Sequence[str] | None = None,
    lag_months: int = LAG_MONTHS,
    lookback_months: int = LOOKBACK_MONTHS,
    file_pattern: str = "%s_tripdata_%s.parquet",
) -> DataFrame:
    """Every (dataset, month) a run should look at, newest month first.

    `runs` has a `run_date`, and a `dataset` column unless `datasets` names them.  The
    window ends `lag_months` before the month of the run.  Months and datasets are
    expanded from arrays on the row, so no join is needed.
    """
    if datasets is not None:
        runs = runs.withColumn("dataset", F.explode(F.array(*[F.lit(d) for d in datasets])))
    months = months_back(month_anchor(F.col("run_date"), lag_months), lookback_months)
    rows = runs.select("dataset", F.explode(months).alias("month"))
    return rows.select("dataset", period_of(F.col("month")).alias("period")).select(
        F.concat_ws("/", "dataset", "period").alias("key"),
        "dataset",
        "period",
        F.format_string(file_pattern, "dataset", "period").alias("filename"),
    )


def classify_candidates(candidates: DataFrame, listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """`status` of each candidate: unpublished, unchanged, restated or new.

    `listing` (key, etag, content_length) is what the source offers now; `manifest` (key,
    etag) is what was taken before.  A candidate missing from the listing is simply not
    there yet and never an error.  A listed file without etag is there: new, or restated
    if another etag was noted.
    """
    offered = listing.select("key", "etag", "content_length", F.lit(True).alias("is_offered"))
    prior = manifest.select("key", F.col("etag").alias("prior_etag"), F.lit(True).alias("has_prior"))
    status = (
        F.when(F.col("is_offered").isNull(), "unpublished")
        .when(F.col("has_prior") & F.col("prior_etag").eqNullSafe(F.col("etag")), "unchanged")
        .when(F.col("has_prior"), "restated")
        .otherwise("new")
    )
    return (
        candidates.join(offered, "key", "left")
        .join(prior, "key", "left")
        .withColumn("status", status)
        .drop("has_prior", "is_offered")
    )


def to_fetch(classified: DataFrame) -> DataFrame:
    """The candidates worth a transfer."""
    return classified.where(F.col("status").isin("new", "restated"))
