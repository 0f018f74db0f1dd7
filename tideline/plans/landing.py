"""The landing run: which files of the source to take, claimed in the manifest, transferred, checked and noted."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.frames import small_frame
from tideline.functions import instant
from tideline.operators.manifest import StoredManifest
from tideline.sources.candidates import classify_candidates, to_fetch
from tideline.sources.files import check_sizes

ENTRY = (
    "key string, dataset string, period string, etag string, content_length bigint, landed_length bigint, "
    "state string, run_id string, noted_at timestamp"
)
CLAIMED, LANDED = "claimed", "landed"
CLAIM_HOURS = 6


@dataclass(frozen=True)
class LandingReport:
    status: list[tuple[str, str]]  # (key, unpublished / unchanged / restated / new / taken) of every candidate
    landed: list[str]
    attempts: int

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(key, status, key in set(self.landed)) for key, status in self.status]
        return small_frame(spark, rows, "key string, status string, landed boolean")


def stored_manifest(spark: SparkSession, folder: str) -> StoredManifest:
    return StoredManifest(spark, folder, ENTRY)


def landing_run(
    spark: SparkSession,
    candidates: DataFrame,
    listing: DataFrame,
    manifest: StoredManifest,
    fetch: Callable[[DataFrame], DataFrame],
    run_id: str,
    at: datetime,
    claim_hours: int = CLAIM_HOURS,
) -> LandingReport:
    """Take the new and restated files of the look-back window.

    1. Candidates are compared with what the source offers (`listing`: key, etag, content_length) and with what
       landed before; files claimed by another run less than `claim_hours` ago are `taken` and left alone.
    2. What is to be fetched is claimed in one commit after the state just read.  If another run committed
       in between, the commit is refused and all is read again: no two runs fetch one file.
    3. `fetch` transfers the claimed files (key, dataset, period, filename, etag, content_length) and returns
       (key, length) of what arrived.
    4. Lengths are checked; a file cut short or absent fails the run, and its claim lapses, so a later run takes it.
    5. Landed files are noted with their etag; a restated file replaces its entry.

    A candidate that the source does not offer is unpublished and no error.  A run that stops anywhere may be repeated.
    """
    attempts = 0
    while True:
        attempts += 1
        version = manifest.version()
        known = manifest.entries(version)
        landed = known.where(F.col("state") == LANDED).select("key", "etag")
        # A claim on a restated file hides its landed entry, which the claim therefore carries on.
        held = known.where(F.col("state") == CLAIMED)
        landed = landed.unionByName(held.where("landed_length IS NOT NULL").select("key", "etag"))
        busy = held.where((F.col("noted_at") > instant(at - timedelta(hours=claim_hours))) & (F.col("run_id") != run_id)).select("key")
        classified = classify_candidates(candidates, listing, landed)
        taken = classified.join(busy.withColumn("__taken", F.lit(True)), "key", "left")
        status = F.when(F.col("__taken") & F.col("status").isin("new", "restated"), "taken").otherwise(F.col("status"))
        decided = taken.withColumn("status", status).drop("__taken").collect()  # a row per month of the window
        rows = small_frame(spark, decided, taken.drop("__taken").schema)
        wanted = to_fetch(rows)
        report = sorted((r["key"], r["status"]) for r in decided)
        if wanted.isEmpty():
            return LandingReport(report, [], attempts)
        # The claim holds the etag of what had landed, so that a lapsed claim leaves the comparison as it was.
        claim = wanted.select(
            "key", "dataset", "period", F.col("prior_etag").alias("etag"), "content_length",
            F.when(F.col("status") == "restated", F.lit(0)).cast("bigint").alias("landed_length"),
            F.lit(CLAIMED).alias("state"), F.lit(run_id).alias("run_id"), instant(at).alias("noted_at"),
        )
        if manifest.commit(claim, version):
            break
    arrived = fetch(wanted).select("key", F.col("length").cast("bigint").alias("length"))
    arrived = small_frame(spark, arrived.collect(), arrived.schema)
    check_sizes(arrived, wanted.select("key", F.col("content_length").alias("length")), "key")
    noted = wanted.join(arrived, "key").select(
        "key", "dataset", "period", "etag", "content_length", F.col("length").alias("landed_length"),
        F.lit(LANDED).alias("state"), F.lit(run_id).alias("run_id"), instant(at).alias("noted_at"),
    )
    manifest.update(noted)
    return LandingReport(report, sorted(r["key"] for r in arrived.collect()), attempts)
