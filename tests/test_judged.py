"""Reports in one pass: the rows of the reports from separate tables, and how often their plans read and shuffle readings."""

import pytest

from voltweave.operators import coverage, health, judged, peaks, readings, rules, sustained, thresholds
from voltweave.plans import fixtures
from voltweave.plans.queries import _QUERIES, Tables

DATA = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def parts(spark):
    """Deduplicated readings of two months, some without a DT, and everything that is found in them apart."""
    df = fixtures.readings(spark, DATA).selectExpr("* except (DATE, DT_CODE_NEW)", "date_add(DATE, 20) as DATE", "case when event_id % 17 = 0 then null else DT_CODE_NEW end as DT_CODE_NEW")
    dedup = readings.raw_dedup(df).persist()
    flags = rules.hard_flags(dedup)
    hard, threshold = rules.hard_anomalies(flags), thresholds.threshold_anomalies(thresholds.rolling_thresholds(dedup))
    yield dedup, rules.clean_readings(flags), hard, threshold, coverage.meter_granularity(dedup, limit=9), judged.judged(dedup, limit=9)
    dedup.unpersist()


def test_same_anomalies_and_granularity(parts):
    dedup, _, hard, threshold, minutes, one = parts
    assert rows(judged.hard_anomalies(one)) == rows(hard) and rows(judged.threshold_anomalies(one)) == rows(threshold)
    assert rows(one.select("MTR_NO", "SLOT_MINUTES").distinct()) == rows(minutes) and one.count() == dedup.count()
    assert {r["DATE"].month for r in one.select("DATE").distinct().collect()} >= {1, 2}


def test_same_reports(spark, parts):
    dedup, clean, hard, threshold, minutes, one = parts
    assert rows(judged.health_of(one)) == rows(health.health(clean, hard, threshold))
    assert rows(judged.health_report(one, 5.0)) == rows(health.health_report(clean, hard, threshold, 5.0))
    ratings = dedup.where("DT_CODE_NEW is not null").selectExpr("DT_CODE_NEW", "30d as DT_KVA_RATING").distinct()
    bad = peaks.bad_slots(hard, threshold)
    assert rows(judged.sustained_daily_clean(one, ratings)) == rows(sustained.sustained_daily_clean(clean, bad, minutes, ratings))
    placed = dedup.where("DT_CODE_NEW is not null")
    raw = peaks.monthly_peak_raw(placed, placed.selectExpr("MTR_NO", "DT_CODE_NEW", "1d as CT_RATIO").distinct(), minutes)
    assert rows(judged.monthly_peaks(one)) == rows(peaks.monthly_peak_clean(raw, clean, bad, minutes).select("MTR_NO", "DT_CODE_NEW", "YM", "PEAK_KVA_RAW", "PEAK_KVA_CLEAN"))


@pytest.mark.parametrize("name, windows", [("health_report", 3), ("health_distribution", 3), ("monthly_peak_clean", 4), ("sustained_daily_clean", 4)])
def test_readings_are_read_once(spark, name, windows):
    plan = _QUERIES[name](Tables(spark, DATA))._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # sustained_daily_clean reads the table again for the fixture's ratings.
    assert plan.count("FileScan") == (2 if name == "sustained_daily_clean" else 1)
    assert plan.count("Window [") <= windows and plan.count("Exchange hashpartitioning") <= 5


def test_no_rows(spark):
    empty = judged.judged(fixtures.readings(spark, DATA).limit(0))
    assert empty.count() == 0 and judged.health_report(empty).count() == 0 and judged.monthly_peaks(empty).count() == 0
