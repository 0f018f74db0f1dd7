"""The landing run: two days, a lost race, a run that stops, files cut short."""

from datetime import datetime

import pytest

from tideline.frames import small_frame
from tideline.plans.landing import LandingReport, landing_run, stored_manifest
from tideline.sources.candidates import candidate_window

AT = datetime(2026, 3, 15)


@pytest.fixture
def window(spark):
    return candidate_window(spark.sql("SELECT date'2026-03-15' AS run_date"), ["yellow", "green"], lookback_months=3)


def offered(spark, *rows):
    return small_frame(spark, rows, "key string, etag string, content_length bigint")


class Source:
    def __init__(self, spark, short=()):
        self.spark, self.short, self.fetched = spark, short, []

    def __call__(self, wanted):
        rows = [(r.key, r.content_length - (r.key in self.short)) for r in wanted.collect()]
        self.fetched += sorted(k for k, _ in rows)
        return small_frame(self.spark, rows, "key string, length bigint")


DAY1 = [("yellow/2026-01", "a", 10), ("yellow/2025-12", "b", 20), ("green/2026-01", "c", 30)]


def test_two_days(spark, tmp_path, window):
    manifest, source = stored_manifest(spark, f"{tmp_path}/m"), Source(spark)
    first = landing_run(spark, window, offered(spark, *DAY1), manifest, source, "r1", AT)
    assert source.fetched == sorted(k for k, _, _ in DAY1) == first.landed
    assert dict(first.status)["green/2025-12"] == "unpublished" and dict(first.status)["yellow/2026-01"] == "new"
    day2 = [("yellow/2026-01", "a2", 11), DAY1[1], DAY1[2], ("green/2025-12", "n", 5)]
    second = landing_run(spark, window, offered(spark, *day2), manifest, source, "r2", datetime(2026, 3, 16))
    assert second.landed == ["green/2025-12", "yellow/2026-01"]
    assert dict(second.status)["yellow/2026-01"] == "restated" and dict(second.status)["yellow/2025-12"] == "unchanged"
    third = landing_run(spark, window, offered(spark, *day2), manifest, source, "r3", datetime(2026, 3, 17))
    assert third.landed == [] and set(dict(third.status).values()) == {"unchanged", "unpublished"}
    held = {r.key: (r.etag, r.state, r.landed_length, r.run_id) for r in manifest.entries().collect()}
    assert held["yellow/2026-01"] == ("a2", "landed", 11, "r2") and held["green/2026-01"] == ("c", "landed", 30, "r1")
    assert manifest.entries(2).count() == 3  # as it was after the first run


def test_two_runs_never_take_one_file(spark, tmp_path, window):
    manifest, ours, theirs = stored_manifest(spark, f"{tmp_path}/m"), Source(spark), Source(spark)
    commit, calls = type(manifest).commit, []

    class Raced(type(manifest)):
        def commit(self, rows, expected):
            if not calls:  # another run reads the same state and is first
                calls.append(landing_run(spark, window, offered(spark, DAY1[0]), stored_manifest(spark, f"{tmp_path}/m"), theirs, "other", AT))
            return commit(self, rows, expected)

    raced = Raced(manifest.spark, manifest.folder, manifest.schema)
    mine = landing_run(spark, window, offered(spark, *DAY1), raced, ours, "mine", AT)
    assert mine.attempts == 2 and theirs.fetched == ["yellow/2026-01"]
    assert ours.fetched == ["green/2026-01", "yellow/2025-12"] and dict(mine.status)["yellow/2026-01"] == "unchanged"


def test_a_number_is_put_once(spark, tmp_path):
    manifest = stored_manifest(spark, f"{tmp_path}/m")
    assert manifest._put(1, "x") and not manifest._put(1, "y") and manifest.version() == 1


def test_a_run_that_stops_keeps_its_claim_for_a_while(spark, tmp_path, window):
    manifest, source = stored_manifest(spark, f"{tmp_path}/m"), Source(spark)
    landing_run(spark, window, offered(spark, *DAY1), manifest, source, "r0", AT)

    def stops(wanted):
        raise OSError("connection lost")

    restated = [("yellow/2026-01", "a2", 11)]
    with pytest.raises(OSError):
        landing_run(spark, window, offered(spark, *restated), manifest, stops, "r1", datetime(2026, 3, 16, 0))
    meanwhile = landing_run(spark, window, offered(spark, *restated), manifest, source, "r2", datetime(2026, 3, 16, 1))
    assert dict(meanwhile.status)["yellow/2026-01"] == "taken" and meanwhile.landed == []
    later = landing_run(spark, window, offered(spark, *restated), manifest, source, "r3", datetime(2026, 3, 16, 7))
    assert dict(later.status)["yellow/2026-01"] == "restated" and later.landed == ["yellow/2026-01"]
    with pytest.raises(OSError):
        landing_run(spark, window, offered(spark, ("green/2025-12", "z", 1)), manifest, stops, "r4", datetime(2026, 3, 17, 0))
    again = landing_run(spark, window, offered(spark, ("green/2025-12", "z", 1)), manifest, source, "r4", datetime(2026, 3, 17, 1))
    assert again.landed == ["green/2025-12"]  # a run repeated under its name goes on with its own claim


def test_a_file_cut_short_is_not_noted(spark, tmp_path, window):
    manifest = stored_manifest(spark, f"{tmp_path}/m")
    with pytest.raises(ValueError, match="size mismatch"):
        landing_run(spark, window, offered(spark, *DAY1), manifest, Source(spark, {"yellow/2025-12"}), "r1", AT)
    assert manifest.entries().where("state = 'landed'").count() == 0
    source = Source(spark)
    assert isinstance(landing_run(spark, window, offered(spark, *DAY1), manifest, source, "r2", datetime(2026, 3, 16)), LandingReport)
    assert source.fetched == sorted(k for k, _, _ in DAY1)
