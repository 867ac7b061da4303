"""Operators on hand-made rows: nulls, limits, ties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltweave.operators import coverage, curve, growth, health, master, peaks, readings, rules, sustained, thresholds

D = dt.date(2024, 1, 10)
NUMBERS = ["VR", "VY", "VB", "IR", "IY", "IB", "KW_R", "KW_Y", "KW_B", "KVAR_R", "KVAR_Y", "KVAR_B", "KWH_TOTAL"]


def reading(**values):
    row = {"MTR_NO": "M1", "DT_CODE_NEW": "D1", "DT_CAT": "REG", "DATE": D, "TIME_SLOT": 1, "meter_seq": 1, "event_id": 1}
    row |= dict.fromkeys(NUMBERS[:3], 230.0) | dict.fromkeys(NUMBERS[3:6], 10.0) | dict.fromkeys(NUMBERS[6:9], 2.0) | dict.fromkeys(NUMBERS[9:12], 1.0) | {"KWH_TOTAL": 5.0}
    return row | values


SCHEMA = "MTR_NO string, DT_CODE_NEW string, DT_CAT string, DATE date, TIME_SLOT int, meter_seq int, event_id long, " + ", ".join(f"{n} double" for n in NUMBERS)
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def table(spark, *rows):
    return spark.createDataFrame([[reading(**r)[n] for n in NAMES] for r in rows], SCHEMA)


def found(spark, *rows):
    return {(r["TIME_SLOT"], r["ANOMALY_TYPE"]) for r in rules.hard_anomalies(rules.hard_flags(table(spark, *rows))).collect()}


def test_limits_are_not_anomalies(spark):
    assert found(spark, {"VR": 180.0}, {"VR": 290.0}, {"IR": 5000.0}, {"KVAR_R": -10.0}) == set()
    assert found(spark, {"KW_R": 0.02}) == {(1, "PHASE_LOSS_KW_R")}
    assert found(spark, {"VR": 179.9}, {"TIME_SLOT": 2, "VR": 290.1}, {"TIME_SLOT": 3, "IR": 5000.1}) == {(1, "EXTREME_VOLTAGE_VR"), (2, "EXTREME_VOLTAGE_VR"), (3, "EXTREME_CURRENT_IR")}


def test_exempt_and_unknown_categories(spark):
    assert found(spark, {"VR": 300.0, "DT_CAT": "MHVD"}) == set()
    assert found(spark, {"VR": 300.0, "DT_CAT": None}) == {(1, "EXTREME_VOLTAGE_VR")}


def test_null_phase_keeps_flag_null(spark):
    flags = rules.hard_flags(table(spark, {"VR": None, "VY": 0.0, "VB": 0.0}))
    assert flags.select("f_zero_v").first()[0] is None
    clean = rules.clean_readings(flags).first()
    assert clean["was_zero_voltage"] is None and clean["VY"] == 0.0


def test_energy_rules(spark):
    assert found(spark, {"KWH_TOTAL": None}, {"TIME_SLOT": 2, "KWH_TOTAL": 0.0}, {"TIME_SLOT": 3, "KWH_TOTAL": 0.0, "IR": 0.0, "IY": 0.0, "IB": None}) == {(1, "MISSING_KWH"), (2, "ZERO_KWH_WITH_LOAD")}


def test_each_anomaly_is_a_true_flag(spark):
    flags = rules.hard_flags(table(spark, {"VR": 0.0, "VY": 0.0, "VB": 0.0, "KVAR_R": -11.0, "IR": 6000.0}, {"TIME_SLOT": 2}))
    n = flags.select(sum(F.coalesce(F.col(f).cast("int"), F.lit(0)) for f in rules.rules())).groupBy().sum().first()[0]
    assert rules.hard_anomalies(flags).count() == n == 3
    first = rules.clean_readings(flags).where("TIME_SLOT = 1").first()
    assert [first[c] for c in ("VR", "VY", "VB", "IR", "KVAR_R", "KW_R")] == [None, None, None, None, None, 2.0]


def test_dedup_prefers_fewer_nulls_then_key(spark):
    df = table(spark, {"event_id": 1, "VR": None}, {"event_id": 3}, {"event_id": 2}, {"event_id": 9, "DATE": dt.date(2023, 12, 24)})
    assert [r["event_id"] for r in readings.raw_dedup(df, ym=202401).collect()] == [2]


def test_month_window():
    assert readings.month_window(202401) == (202312, dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2023, 12, 25))
    assert readings.month_window(202312)[2] == dt.date(2023, 12, 31)


MASTER = "MTR_NO string, MONTH int, DT_CODE_NEW string, SDO_CD string, CT_RATIO double, DT_CAT string"


def placed(spark, rows, reads):
    m = spark.createDataFrame(rows, MASTER)
    r = spark.createDataFrame(reads, "MTR_NO string, DATE date, IR double")
    out = readings.asof_master_join(r, m, master.earliest_master(m), master.meter_sequence(m))
    return out, {(x["MTR_NO"], x["DATE"]): x for x in readings.ct_scaling(out).collect()}


def test_asof_backfill_and_unknown_meter(spark):
    rows = [("A", 202402, "D1", "F1", 2.0, "REG"), ("A", 202404, "D2", "F1", 3.0, "REG"), ("B", 202401, "D1", "F1", None, None)]
    reads = [("A", dt.date(2024, 1, 5), 1.0), ("A", dt.date(2024, 3, 5), 1.0), ("A", dt.date(2024, 4, 5), 1.0), ("X", dt.date(2024, 4, 5), 1.0)]
    df, out = placed(spark, rows, reads)
    got = [(out[k]["DT_CODE_NEW"], out[k]["IR"], out[k]["ct_scaled"]) for k in sorted(out)]
    assert got == [("D1", 2.0, True), ("D1", 2.0, True), ("D2", 3.0, True), (None, 1.0, False)]
    assert out[("A", dt.date(2024, 3, 5))]["is_meter_replaced"] and not out[("X", dt.date(2024, 4, 5))]["is_meter_replaced"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_repeated_master_month_doesnt_repeat_readings(spark):
    rows = [("A", 202401, "D2", "F1", 1.0, None), ("A", 202401, "D1", "F1", 1.0, None)]
    df, _ = placed(spark, rows, [("A", dt.date(2024, 1, 5), 1.0)])
    assert [r["DT_CODE_NEW"] for r in df.collect()] == ["D1"]


def test_stitching_takes_the_newest_even_if_null(spark):
    df = table(spark, {"MTR_NO": "OLD", "meter_seq": 1}, {"MTR_NO": "NEW", "meter_seq": 2, "KWH_TOTAL": None})
    out = readings.dt_stitched_readings(df).collect()
    assert [(r["MTR_NO"], r["KWH_TOTAL"]) for r in out] == [("NEW", None)]


def test_expected_slots_ties_go_low(spark):
    counts = spark.createDataFrame([("M", 96), ("M", 48), ("M", 96), ("M", 48)], "MTR_NO string, slots_present long")
    assert coverage.expected_slots(counts).first()["expected_slots_per_day"] == 48
    days = spark.createDataFrame([("M", "D", D, 40)], "MTR_NO string, DT_CODE_NEW string, DATE date, slots_present long")
    row = coverage.missing_slot_days(days, coverage.expected_slots(counts)).first()
    assert (row["missing_slot_count"], row["GAP_TYPE"]) == (8, "PARTIAL_40_OF_48")


def test_granularity(spark):
    df = table(spark, *[{"TIME_SLOT": i} for i in range(61)], *[{"MTR_NO": "M2", "TIME_SLOT": i} for i in range(60)])
    assert {r["MTR_NO"]: r["SLOT_MINUTES"] for r in coverage.meter_granularity(df).collect()} == {"M1": 15, "M2": 30}


def thresholds_of(spark, *rows):
    return [(r["DATE"].day, r["PARAMETER"], r["DIRECTION"]) for r in thresholds.threshold_anomalies(thresholds.rolling_thresholds(table(spark, *rows))).collect()]


def test_rolling_rows_not_days(spark):
    rows = [{"DATE": dt.date(2024, 1, d), "IR": 10.0} for d in (1, 3, 9)] + [{"DATE": dt.date(2024, 1, 20), "IR": 10.51}]
    assert thresholds_of(spark, *rows) == [(20, "IR", "HIGH")]
    assert thresholds_of(spark, *rows[:1]) == []


def test_low_needs_a_positive_floor(spark):
    assert thresholds_of(spark, {"DATE": dt.date(2024, 1, 1), "IR": 0.0}, {"DATE": dt.date(2024, 1, 2), "IR": -5.0}) == []
    assert thresholds_of(spark, {"DATE": dt.date(2024, 1, 1), "IR": 10.0}, {"DATE": dt.date(2024, 1, 2), "IR": 9.49}) == [(2, "IR", "LOW")]


def test_lookback_crosses_the_month_for_seven_days(spark):
    late = [{"DATE": dt.date(2024, 1, 26), "IR": 10.0}, {"DATE": dt.date(2024, 2, 3), "IR": 20.0}]
    early = [{"DATE": dt.date(2024, 1, 24), "IR": 10.0}, {"DATE": dt.date(2024, 2, 3), "IR": 20.0}]
    assert thresholds_of(spark, *late) == [(3, "IR", "HIGH")]
    assert thresholds_of(spark, *early) == []


def test_one_exchange_for_all_parameters(spark):
    plan = thresholds.rolling_thresholds(table(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_loading_bands(spark):
    df = spark.createDataFrame([(x,) for x in (0.69, 0.70, 0.80, 1.20, None)], "x double")
    from voltweave.functions.columns import loading_band

    assert [r[0] for r in df.select(loading_band(F.col("x"))).collect()] == [None, "70-80%", "80-90%", ">120%", None]


def test_zero_rating_has_no_loading(spark):
    minutes = spark.createDataFrame([("M1", 30)], "MTR_NO string, SLOT_MINUTES int")
    ratings = spark.createDataFrame([("D1", 0.0)], "DT_CODE_NEW string, DT_KVA_RATING double")
    place = spark.createDataFrame([("M1", "D1")], "MTR_NO string, DT_CODE_NEW string")
    assert sustained.sustained_daily_raw(table(spark, {}), place, minutes, ratings).count() == 0


def test_coincidental_peaks_read_the_days_once(spark):
    """Two meters of a DT, two DTs of a location; a category of nulls and a day without values."""
    rows = [("a", "D1", "F1", None, dt.date(2024, 1, 1), 3.0), ("b", "D1", "F1", None, dt.date(2024, 1, 1), 5.0), ("c", "D2", "F1", "X", dt.date(2024, 2, 1), None)]
    daily = spark.createDataFrame(rows, "MTR_NO string, DT_CODE_NEW string, SDO_CD string, DT_CAT string, DATE date, DAILY_KVA_SUM double")
    out = peaks.coincidental_peak_yearly(peaks.coincidental_peak_monthly(daily))
    want = {("DT", "D1", 202401): 5.0, ("DT", "D2", 202402): None, ("FL", "F1", 202401): 8.0, ("FL", "F1", 202402): 0.0, ("CAT", "X", 202402): 0.0}
    want |= {("DT_YEARLY", "D1", None): 5.0, ("DT_YEARLY", "D2", None): None, ("FL_YEARLY", "F1", None): 8.0, ("CAT_YEARLY", "X", None): 0.0}
    assert {(r["LEVEL"], r["KEY"], r["YM"]): r["PEAK"] for r in out.collect()} == want
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_cleaning_methods(spark):
    day = dt.date(2024, 1, 20)
    window = spark.createDataFrame([("m", day - dt.timedelta(days=d), 1, 2.0) for d in (1, 2, 3)], "MTR_NO string, DATE date, TIME_SLOT int, KW_R double")
    grid = spark.createDataFrame([("m", 1, 1)], "MTR_NO string, TIME_SLOT int, POS int")
    assert curve.predicted_by("Off", window, grid, "KW_R", day) is None
    for method in ("Regression", "Auto"):
        assert [(r["MTR_NO"], r["TIME_SLOT"], r["PREDICTED"]) for r in curve.predicted_by(method, window, grid, "KW_R", day).collect()] == [("m", 1, 2.0)]


def test_sustained_clean_has_no_fallback(spark):
    df = table(spark, {"MTR_NO": "OLD", "meter_seq": 1}, {"MTR_NO": "NEW", "meter_seq": 2})
    minutes = spark.createDataFrame([("OLD", 30), ("NEW", 30)], "MTR_NO string, SLOT_MINUTES int")
    ratings = spark.createDataFrame([("D1", 5.0)], "DT_CODE_NEW string, DT_KVA_RATING double")
    bad = df.where("MTR_NO = 'NEW'").select("MTR_NO", "DATE", "TIME_SLOT")
    assert sustained.sustained_daily_clean(df, bad, minutes, ratings).count() == 0
    assert sustained.sustained_daily_clean(df, bad.limit(0), minutes, ratings).first()["hours_in_band"] == 0.5


def test_clean_peaks_without_good_slots(spark):
    df = table(spark, {}, {"MTR_NO": "M2"})
    raw = spark.createDataFrame([("M1", "D1", 202401, 9.0), ("M2", "D1", 202401, 9.0)], "MTR_NO string, DT_CODE_NEW string, YM int, PEAK_KVA_RAW double")
    minutes = spark.createDataFrame([("M1", 30)], "MTR_NO string, SLOT_MINUTES int")
    out = {r["MTR_NO"]: r["PEAK_KVA_CLEAN"] for r in peaks.monthly_peak_clean(raw, df, df.where("MTR_NO = 'M2'"), minutes).collect()}
    assert out["M2"] is None and out["M1"] == pytest.approx((36 + 9) ** 0.5)


def test_yoy_uses_the_last_year_there_is(spark):
    df = spark.createDataFrame([("D", 2000, 0.0), ("D", 2001, 10.0), ("D", 2004, 15.0)], "DT_CODE_NEW string, YEAR int, YEARLY_PEAK double")
    assert [r["YOY_PCT"] for r in growth.yoy_growth(df).orderBy("YEAR").collect()] == [None, None, 50.0]


def test_health_rounds_before_the_limit(spark):
    rows = [{"TIME_SLOT": i} for i in range(2502)]
    df = table(spark, *rows)
    bad = rules.hard_anomalies(rules.hard_flags(df)).limit(0)
    hard = df.where("TIME_SLOT < 1252").select("MTR_NO", "DT_CODE_NEW", "DT_CAT", "DATE", "TIME_SLOT", F.lit("X").alias("ANOMALY_TYPE"), F.lit("HIGH").alias("SEVERITY"))
    empty = spark.createDataFrame([], "MTR_NO string, DT_CODE_NEW string, DATE date, TIME_SLOT int, PARAMETER string, VALUE double, THRESH_HI double, THRESH_LO double, DIRECTION string")
    row = health.health_report(df, hard.union(bad), empty).first()
    assert (row["health_pct"], row["top_anomaly_type"], row["anomaly_type_breakdown"]) == (50.0, "X", "X:1252")


def test_day_curve_and_gaps(spark):
    rows = [{"TIME_SLOT": s, "KW_R": float(s)} for s in (1, 4, 6)] + [{"TIME_SLOT": s, "DATE": dt.date(2024, 1, 9), "KW_R": 3.0} for s in range(1, 8)]
    minutes = spark.createDataFrame([("M1", 30)], "MTR_NO string, SLOT_MINUTES int")
    window = curve.meter_window(table(spark, *rows), minutes, D)
    day = curve.day_curve(window, curve.slot_grid(window), "KW_R", D)
    runs = {r["TIME_SLOT"]: (r["GAP_POSITION"], r["GAP_LENGTH"], r["METHOD"]) for r in curve.missing_slot_runs(day).collect()}
    assert runs == {2: (1, 2, "linear"), 3: (2, 2, "linear"), 5: (1, 1, "linear"), 7: (1, 1, None)}
    lines = {r["TIME_SLOT"]: r["FILLED"] for r in curve.interpolate_linear(day).collect()}
    assert lines == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: None}
    assert {r["TIME_SLOT"]: r["FILLED"] for r in curve.interpolate_gaps(day).collect()} == lines
    band = curve.threshold_band_7d(window, "KW_R", D)
    assert {r["TIME_SLOT"]: r["ANOMALY_DIR"] for r in curve.band_anomalies(day, band).collect()} == {1: "LOW", 4: "HIGH", 6: "HIGH"}


def test_hierarchy_and_ambiguous_meters(spark):
    m = spark.createDataFrame([("A", 202401, "D1", "F1", 1.0, None), ("B", 202402, "D1", "F1", 1.0, "REG"), ("A", 202403, "D2", "F1", 1.0, None)], MASTER)
    h = master.hierarchy(m, master.meter_sequence(m))
    assert sorted((r["DT_CODE_NEW"], r["MTR_NO"], r["meter_seq"], r["is_meter_replaced"]) for r in h.collect()) == [("D1", "A", 1, True), ("D1", "B", 2, True), ("D2", "A", 1, False)]
    assert [(r["MTR_NO"], r["n_places"], r["DT_CODE_NEW"]) for r in master.ambiguous_meters(m).collect()] == [("A", 2, "D1")]
    assert master.dt_summary(h.withColumn("KVA_RATING", F.lit(100.0))).first()["DT_CAT"] == "REG"


def test_boosting_takes_every_meter_and_all_rounds(spark):
    import numpy as np

    from voltweave.plans import queries

    x = np.arange(200.0).reshape(-1, 1) % 20
    y = np.where(x[:, 0] < 10, 1.0, 5.0)
    assert curve.boost(x, y, np.array([[3.0], [15.0]])) == pytest.approx([1, 5], abs=1e-3)
    assert abs(curve.boost(x, y, np.array([[15.0]]), 15)[0] - 5) > 0.3
    days = [D - dt.timedelta(days=k) for k in range(1, 101)]
    made = [(m, d, s, float(k + s)) for k, m in enumerate(("A", "B")) for d in days for s in (0, 1)] + [("C", days[0], s, 2.0) for s in (0, 1)]
    window = spark.createDataFrame(made, "MTR_NO string, DATE date, TIME_SLOT int, KW_R double")
    out = {(r["MTR_NO"], r["TIME_SLOT"]): r["PREDICTED"] for r in curve.boosted_curves(window, curve.slot_grid(window), "KW_R", D).collect()}
    assert out == pytest.approx({(m, s): k + s for k, m in ((0, "A"), (1, "B")) for s in (0, 1)} | {("C", 0): 2.0, ("C", 1): 2.0}, abs=1e-3)
    assert not hasattr(queries, "BOOSTING_ROUNDS")
