"""Boosted trees of many meters at once: as each on its own, and over all partitions."""

import datetime as dt

import numpy as np

from voltweave.operators import curve

D = dt.date(2024, 1, 20)


def test_series_at_once_equal_each_alone():
    rng = np.random.default_rng(3)
    series = []
    for n, slots, days in ((1, 1, 1), (60, 1, 9), (200, 12, 18), (90, 48, 180), (50, 12, 1)):
        slot, day = rng.integers(0, slots, n), rng.integers(0, days, n)
        features = lambda s, d: np.stack([s, 0 * s, d % 7, d, np.sin(s)], 1).astype(float)
        series.append((features(slot, day), rng.normal(5, 2, n).round(2), features(np.arange(slots), np.full(slots, days))))
    both = curve.boost_each(series, 20)
    assert [len(b) for b in both] == [1, 1, 12, 48, 12]
    assert all((b == curve.boost(*s, 20)).all() for b, s in zip(both, series, strict=True))
    assert len({tuple(b) for b in both}) == 5


def test_meters_are_dealt_over_all_partitions(spark):
    made = [(f"M{m}", D - dt.timedelta(days=k), s, float(m + s)) for m in range(40) for k in range(1, 31) for s in (0, 1)]
    window = spark.createDataFrame(made, "MTR_NO string, DATE date, TIME_SLOT int, KW_R double")
    out = curve.boosted_curves(window, curve.slot_grid(window), "KW_R", D, 20)
    rows = out.collect()
    assert sorted((r["MTR_NO"], r["TIME_SLOT"]) for r in rows) == sorted((f"M{m}", s) for m in range(40) for s in (0, 1))
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    # A meter's rows are few bytes and much work: AQE doesn't merge partitions whose number was asked for.
    assert out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count(f", {parts}), REPARTITION_BY_NUM") == 2
