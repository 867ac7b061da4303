"""The registered queries: operators on the fixtures. Doubles are rounded to 7 places, as engines add them up in different orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltweave.constants import BOOSTING_DAYS
from voltweave.functions.columns import month_of, normalize_meter_id, slot_kva
from voltweave.operators import anomalies, checks, coverage, curve, forecast, growth, health, judged, master, peaks, readings, rules, sustained, thresholds
from voltweave.plans import fixtures, pipeline
from voltweave.sources.store import cache_by_month, month_stamps, scratch_path

DAY, YM, STALE_YM = dt.date(2024, 1, 20), 202401, 199603
YEARS = list(range(1992, 2002))


class Tables:
    """What the queries start from, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, days: int = 18):
        self.spark, self.sf_dir, self.days = spark, sf_dir, days

    def __getattr__(self, name: str):
        made = _TABLES[name](self)
        setattr(self, name, made)
        return made


_TABLES = {
    # Raw monthly peaks as they are read back from a cache that holds each month with a stamp of its readings; stale: one month was built from others.
    "cached_monthly": lambda t: _cached(t, t.loads),
    "stale_monthly": lambda t: _cached(t, t.loads.withColumn("IR", F.when(month_of(F.col("DATE")) == STALE_YM, F.col("IR") * 3).otherwise(F.col("IR"))).withColumn("KW_R", F.when(month_of(F.col("DATE")) == STALE_YM, F.col("KW_R") * 3).otherwise(F.col("KW_R")))),
    "load_days": lambda t: coverage.daily_slot_counts(t.loads),
    "readings": lambda t: fixtures.readings(t.spark, t.sf_dir),
    "dedup": lambda t: readings.raw_dedup(t.readings),
    "judged": lambda t: judged.judged(t.dedup, limit=9),
    "flags": lambda t: rules.hard_flags(t.dedup),
    "hard": lambda t: rules.hard_anomalies(t.flags),
    "clean": lambda t: rules.clean_readings(t.flags),
    "threshold": lambda t: thresholds.threshold_anomalies(thresholds.rolling_thresholds(t.dedup)),
    "bad": lambda t: peaks.bad_slots(t.hard, t.threshold),
    "minutes": lambda t: coverage.meter_granularity(t.dedup, limit=9),
    "counts": lambda t: coverage.daily_slot_counts(t.dedup),
    "stitched": lambda t: readings.dt_stitched_readings(t.dedup),
    "missing_dt": lambda t: coverage.missing_slot_days((c := coverage.daily_slot_counts(t.stitched, coverage.DT)), coverage.expected_slots(c, "DT_CODE_NEW"), "DT_CODE_NEW"),
    "anomalies": lambda t: anomalies.categorized_of(t.judged, t.missing_dt),
    "loads": lambda t: fixtures.loads(t.spark, t.sf_dir),
    "places": lambda t: fixtures.places(t.spark, t.sf_dir),
    "place_minutes": lambda t: t.places.select("MTR_NO", F.when(F.col("is_15"), 15).otherwise(30).alias("SLOT_MINUTES")),
    "master": lambda t: master.master_timeaware(fixtures.master(t.spark, t.sf_dir)),
    "earliest": lambda t: master.earliest_master(t.master),
    "sequence": lambda t: master.meter_sequence(t.master),
    "hierarchy": lambda t: master.hierarchy(t.master, t.sequence),
    "daily": lambda t: peaks.daily_kva_sum(t.loads, t.places, t.place_minutes),
    "monthly": lambda t: peaks.monthly_peak_raw(t.loads, t.places, t.place_minutes),
    "clean_peaks": lambda t: judged.monthly_peaks(t.judged),
    "yearly": lambda t: growth.yearly_peak(t.monthly),
    "growth": lambda t: growth.yoy_growth(t.yearly),
    "ratings": lambda t: sustained.dt_rating(t.places),
    "sustained": lambda t: sustained.sustained_daily_raw(t.loads, t.places, t.place_minutes, t.ratings),
    "clean_ratings": lambda t: t.readings.select("DT_CODE_NEW").distinct().withColumn("DT_KVA_RATING", F.lit(30.0)),
    "band_hours": lambda t: sustained.band_hours_monthly(t.sustained),
    "window": lambda t: curve.meter_window(t.dedup, t.minutes, DAY, t.days),
    "grid": lambda t: curve.slot_grid(t.window),
    "curve": lambda t: curve.day_curve(t.window, t.grid, "KW_R", DAY),
    "band": lambda t: curve.threshold_band_7d(t.window, "KW_R", DAY),
    "flagged": lambda t: curve.band_anomalies(t.curve, t.band),
    "regression": lambda t: curve.regression_curve(t.window, t.grid, "KW_R", DAY),
    "report": lambda t: judged.health_of(t.judged),
    "forecasts": lambda t: forecast.forecasts(t.yearly, target=2003),
}

_RULES = ["DT_CODE_NEW", "MTR_NO", "DATE", "TIME_SLOT"]


def _cached(t: Tables, loads: DataFrame) -> DataFrame:
    def build(months: list[int]) -> DataFrame:
        return peaks.monthly_peak_raw(loads.where(month_of(F.col("DATE")).isin(months)), t.places, t.place_minutes)

    return cache_by_month(t.spark, scratch_path(t.spark, "monthly-peaks"), month_stamps(loads, month_of(F.col("DATE"))), build)


def _detail(t: Tables) -> DataFrame:
    raw = t.loads.drop("DT_CODE_NEW", "SDO_CD").withColumn("SOURCE_YM", month_of(F.col("DATE"))).withColumnRenamed("DATE", "OCCUR_D_RAW")
    return pipeline.raw_detail(raw, t.master, "FL2").select("SOURCE_YM", "DT_CODE_NEW", "SDO_CD", "MTR_NO", "OCCUR_D_RAW", "TIME_SLOT", "ok", "pk", "IR", "KWH_TOTAL")


def _observed(t: Tables) -> DataFrame:
    stages = {"readings": lambda df: df, "dedup": readings.raw_dedup, "bad": lambda df: judged.judged(df, limit=9), "stitched": readings.dt_stitched_readings}
    return checks.observed_counts(t.readings, stages, {"bad": F.col("IS_BAD")})


def _to(c: str, places: int) -> Column:
    """What is solved for from sums differs in more of its last digits."""
    return F.round(c, places).alias(c)


def _placed(t: Tables) -> DataFrame:
    """LOADS without their own place, joined to the time-aware master."""
    return readings.asof_master_join(t.loads.drop("DT_CODE_NEW", "SDO_CD"), t.master, t.earliest, t.sequence)


def _month_window(t: Tables) -> DataFrame:
    before, first, last, start = readings.month_window(YM)
    return t.spark.createDataFrame([(before, first, last, start)], "previous int, first_day date, last_day date, lookback_start date")


_QUERIES = {
    "raw_dedup": lambda t: t.dedup,
    "asof_master_join": lambda t: _placed(t).select("MTR_NO", "DATE", "TIME_SLOT", "ok", "pk", "DT_CODE_NEW", "SDO_CD", "CT_RATIO", "DT_CAT", "meter_seq", "dt_meter_rank", "is_meter_replaced"),
    "ct_scaling": lambda t: readings.ct_scaling(_placed(t)).select("MTR_NO", "DATE", "TIME_SLOT", "ok", "IR", "KW_Y", "KVAR_B", "KWH_TOTAL", "VR", "ct_scaled"),
    "base_month": lambda t: readings.base_month(t.dedup, YM).select(*_RULES),
    "month_window": _month_window,
    "daily_slot_counts": lambda t: t.counts,
    "meter_expected_slots": lambda t: coverage.expected_slots(t.counts),
    "missing_slot_days": lambda t: coverage.missing_slot_days(t.counts, coverage.expected_slots(t.counts)),
    "missing_slot_days_calendar": lambda t: coverage.missing_calendar_days(t.load_days, coverage.expected_slots(t.load_days)).select("MTR_NO", "DATE", "slots_present", "expected_slots_per_day", "missing_slot_count", "GAP_TYPE"),
    "offline_runs": lambda t: coverage.offline_runs(t.load_days),
    "dt_stitched_readings": lambda t: t.stitched.select(*_RULES, "meter_seq", "KWH_TOTAL"),
    "missing_slot_days_dt": lambda t: t.missing_dt,
    "rolling_thresholds": lambda t: thresholds.rolling_thresholds(t.dedup).select("MTR_NO", "DATE", "TIME_SLOT", "KW_R_HI", "KW_R_LO", "VR_HI", "VR_LO"),
    "threshold_anomalies": lambda t: t.threshold,
    "hard_flags": lambda t: t.flags.select("MTR_NO", "DATE", "TIME_SLOT", *rules.rules()),
    "hard_anomalies": lambda t: t.hard,
    "hard_anomaly_counts": lambda t: t.hard.groupBy("ANOMALY_TYPE", "SEVERITY").agg(F.count("*").alias("n")),
    "clean_readings": lambda t: t.clean.drop("event_id"),
    "master_timeaware": lambda t: t.master,
    "earliest_master": lambda t: t.earliest,
    "meter_sequence": lambda t: t.sequence,
    "replacement_stats": lambda t: master.replacement_stats(t.sequence),
    "category_distribution": lambda t: master.category_distribution(t.master),
    "hierarchy": lambda t: t.hierarchy,
    "fleet_summary": lambda t: master.fleet_summary(t.hierarchy),
    "dt_summary": lambda t: master.dt_summary(t.hierarchy).drop("DT_STS"),
    "dt_summary_page": lambda t: master.dt_summary(t.hierarchy, page=2, per_page=10).select("SDO_CD", "DT_CODE_NEW", "N_METERS"),
    "meters_of_dt": lambda t: master.meters_of_dt(t.hierarchy, "DT7").select("MTR_NO", "meter_seq", "dt_meter_rank"),
    "ambiguous_meters": lambda t: master.ambiguous_meters(t.master),
    "normalize_meter_id": lambda t: t.spark.read.parquet(f"{t.sf_dir}/supplier.parquet").select("s_suppkey", normalize_meter_id(F.concat(F.lit(" "), F.col("s_suppkey").cast("string"), F.lit(".0 "))).alias("MTR_NO")),
    "meter_granularity": lambda t: t.minutes,
    "slot_kva": lambda t: t.dedup.join(t.minutes, "MTR_NO").select("MTR_NO", "DATE", "TIME_SLOT", slot_kva(F.col("SLOT_MINUTES")).alias("KVA")),
    "daily_kva_sum": lambda t: t.daily,
    "coincidental_peak_monthly": lambda t: peaks.coincidental_peak_monthly(t.daily),
    "coincidental_peak_yearly": lambda t: peaks.coincidental_peak_yearly(peaks.coincidental_peak_monthly(t.daily)),
    "monthly_peak_raw": lambda t: t.monthly,
    "monthly_peak_clean": lambda t: t.clean_peaks,
    "monthly_peak_reconstructed": lambda t: peaks.monthly_peak_reconstructed(t.clean, t.bad, t.minutes).withColumn("PEAK_KVA_RECONSTRUCTED", F.round("PEAK_KVA_RECONSTRUCTED", 4)),
    "peak_delta_kpis": lambda t: peaks.peak_delta_kpis(t.clean_peaks),
    "peak_pivot": lambda t: peaks.pivot(t.monthly.where("YEAR = 1996"), "DT_CODE_NEW", "YM", list(range(199601, 199613)), "PEAK_KVA_RAW"),
    "peak_pivot_both": lambda t: peaks.pivot_both(t.clean_peaks, [202312, 202401, 202402]),
    "yearly_peak": lambda t: t.yearly,
    "yoy_growth": lambda t: t.growth,
    "growth_kpis": lambda t: growth.growth_kpis(t.growth),
    "growth_pivot": lambda t: peaks.pivot(t.yearly, "DT_CODE_NEW", "YEAR", YEARS, "YEARLY_PEAK"),
    "compound_growth": lambda t: growth.compound_growth(t.yearly),
    "dt_rating": lambda t: t.ratings,
    "sustained_daily_raw": lambda t: t.sustained,
    "sustained_daily_clean": lambda t: judged.sustained_daily_clean(t.judged, t.clean_ratings),
    "band_hours_monthly": lambda t: t.band_hours,
    "sustained_flag": lambda t: sustained.sustained_flag(t.band_hours),
    "sustained_kpis": lambda t: sustained.sustained_kpis(t.band_hours),
    "sustained_pivot": lambda t: peaks.pivot(t.band_hours.where("YEAR = 1996"), "DT_CODE_NEW", "YM", list(range(199601, 199613)), "hours_in_band", "sum"),
    "meter_window": lambda t: t.window.select("MTR_NO", "DATE", "TIME_SLOT", "KVA"),
    "active_meters": lambda t: curve.active_meters(t.dedup, t.dedup.select("MTR_NO", "DT_CODE_NEW").distinct(), "DT3", DAY),
    "slot_grid": lambda t: t.grid,
    "day_curve": lambda t: t.curve,
    "threshold_band_7d": lambda t: t.band,
    "band_anomalies": lambda t: t.flagged.select("MTR_NO", "TIME_SLOT", "ACTUAL", "ANOMALY_DIR", "IS_ANOMALY"),
    "missing_slot_runs": lambda t: curve.missing_slot_runs(t.curve),
    "interpolate_linear": lambda t: curve.interpolate_linear(t.curve),
    "interpolate_gaps": lambda t: curve.interpolate_gaps(t.curve),
    "regression_curve": lambda t: t.regression,
    "boosted_curve": lambda t: curve.boosted_curves(w := curve.meter_window(t.dedup, t.minutes, DAY), curve.slot_grid(w), "KW_R", DAY),
    "clean_curve_off": lambda t: curve.clean_curve(curve.interpolate_linear(t.curve), t.flagged, curve.predicted_by("Off", t.window, t.grid, "KW_R", DAY)).select("MTR_NO", "TIME_SLOT", "POS", "CLEAN"),
    "clean_curve_gaps": lambda t: curve.clean_curve(curve.interpolate_gaps(t.curve), t.flagged, t.regression).select("MTR_NO", "TIME_SLOT", "POS", "CLEAN"),
    "clean_curve_auto": lambda t: curve.clean_curve(curve.interpolate_gaps(t.curve), t.flagged, curve.predicted_by("Auto", w := curve.meter_window(t.dedup, t.minutes, DAY), curve.slot_grid(w), "KW_R", DAY)).select("MTR_NO", "TIME_SLOT", "POS", "CLEAN"),
    "clean_curve": lambda t: curve.clean_curve(curve.interpolate_linear(t.curve), t.flagged, t.regression).select("MTR_NO", "TIME_SLOT", "POS", "CLEAN"),
    "curve_slope": lambda t: curve.curve_slope(t.curve).select("MTR_NO", "TIME_SLOT", "SLOPE"),
    "curve_kpis": lambda t: curve.curve_kpis(t.curve, t.flagged, t.band),
    "fit_best_model": lambda t: t.forecasts.select("DT_CODE_NEW", "METHOD", _to("FORECAST", 4), _to("LOO_ERROR", 3)),
    "dt_forecast": lambda t: t.forecasts.select("DT_CODE_NEW", "METHOD", _to("FORECAST", 4), _to("LOO_ERROR", 3), "CURRENT_PEAK", _to("GROWTH_PCT", 4)),
    "fl_forecast": lambda t: forecast.fl_forecast(t.forecasts, t.places).select("SDO_CD", _to("FORECAST", 4), _to("CURRENT_PEAK", 4), "n_dts"),
    "health_report": lambda t: judged.health_report(t.judged, 20.0),
    "health_distribution": lambda t: health.health_distribution(t.report),
    "health_span": lambda t: health.health_span(t.clean, t.report, 40.0),
    "total_dts": lambda t: health.total_dts(t.clean),
    "anomaly_search": lambda t: anomalies.anomaly_search(t.anomalies, "Phase Loss (KW/KVAR)", start=dt.date(2024, 1, 5), end=DAY).drop("SEVERITY"),
    "anomaly_search_fl": lambda t: anomalies.anomaly_search(t.anomalies, fl="FL2", start=DAY, end=DAY, hierarchy=t.hierarchy).drop("SEVERITY"),
    "anomaly_summary": lambda t: anomalies.anomaly_summary(t.anomalies),
    "anomaly_types": lambda t: anomalies.anomaly_types(t.anomalies),
    "check_anomalies_match": lambda t: checks.anomalies_match(t.clean, t.hard),
    "check_meters_per_month": lambda t: checks.meters_per_month(t.readings, t.clean),
    "check_nulls_kept": lambda t: checks.nulls_kept(t.dedup, t.clean),
    "check_zero_voltage": lambda t: checks.zero_voltage_nulled(t.clean),
    "check_missing_dt": lambda t: checks.missing_dt(t.clean),
    "check_top_slots": lambda t: checks.top_slots(t.dedup, t.hard, "M1"),
    "check_key_overlap": lambda t: checks.key_overlap(t.loads, t.master),
    "check_equal_peaks": lambda t: checks.equal_peaks(t.clean_peaks),
    "check_unique_placement": lambda t: checks.unique_placement(t.hierarchy),
    "check_months_not_cleaned": lambda t: checks.months_not_cleaned(t.readings, t.clean),
    "check_both_kva": lambda t: checks.both_kva(t.dedup),
    "check_recomputed": lambda t: checks.recomputed(t.cached_monthly, t.monthly, ["MTR_NO", "DT_CODE_NEW", "YEAR", "YM"], "PEAK_KVA_RAW"),
    "check_schema_difference": lambda t: checks.schema_difference(t.dedup, t.clean),
    "check_stale_cache": lambda t: checks.recomputed(t.stale_monthly, t.monthly, ["MTR_NO", "DT_CODE_NEW", "YEAR", "YM"], "PEAK_KVA_RAW"),
    "check_months_behind": lambda t: checks.months_not_cleaned(t.loads, t.loads.where(F.year("DATE") < 1998)),
    "check_ct_ratios": lambda t: checks.ct_ratios(t.master),
    "check_granularity": lambda t: checks.granularity(t.dedup, t.minutes),
    "check_observed_counts": _observed,
    "raw_detail_export": _detail,
    "check_source_files": lambda t: checks.source_files(t.spark.read.parquet(f"{t.sf_dir}/events.parquet")).select("n_rows"),
    "check_columns": lambda t: checks.columns_of(t.master).select("column_name"),
    "check_first_difference": lambda t: checks.first_difference(t.clean_peaks),
    "check_staged_counts": lambda t: checks.staged_counts(readings=t.readings, dedup=t.dedup, stitched=t.stitched, bad=t.bad),
    "half_hours": lambda t: curve.half_hours(t.spark),
    "check_drift": lambda t: checks.drift(t.dedup.withColumn("part", F.when(F.col("DATE") < F.lit(DAY), "train").otherwise("test")), "part", "KW_R"),
}


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{c}`"), 7).alias(c) if kind == "double" else F.col(f"`{c}`") for c, kind in df.dtypes])


def _query(name: str):
    return lambda spark, sf_dir: rounded(_QUERIES[name](Tables(spark, sf_dir)))


#: The load-curve queries over the operators' own 180 days, beside those over 18.
FULL = ("meter_window", "slot_grid", "day_curve", "threshold_band_7d", "band_anomalies", "missing_slot_runs", "interpolate_linear", "interpolate_gaps", "regression_curve", "clean_curve", "clean_curve_gaps", "clean_curve_off", "curve_slope", "curve_kpis")


def _full(name: str):
    return lambda spark, sf_dir: rounded(_QUERIES[name](Tables(spark, sf_dir, BOOSTING_DAYS)))


QUERIES = {name: _query(name) for name in _QUERIES} | {f"{name}_full": _full(name) for name in FULL}
