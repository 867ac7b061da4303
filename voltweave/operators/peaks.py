"""Peaks of apparent power: daily sums, coincidental peaks, and each meter's monthly peak, raw and clean."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltweave.functions.columns import month_of, slot_kva

SLOT = ("MTR_NO", "DATE", "TIME_SLOT")


def _with_kva(readings: DataFrame, granularity: DataFrame) -> DataFrame:
    return readings.join(granularity, "MTR_NO", "left").withColumn("KVA", slot_kva(F.col("SLOT_MINUTES")))


def _placed(readings: DataFrame, hierarchy: DataFrame, *cols: str) -> DataFrame:
    """Readings of meters that the hierarchy knows, with these of its columns in place of their own."""
    h = hierarchy.where("DT_CODE_NEW is not null").select("MTR_NO", *cols)
    return readings.drop(*cols).join(h, "MTR_NO")


def bad_slots(*anomalies: DataFrame) -> DataFrame:
    """Distinct (meter, date, slot) of any anomaly; what no anomaly table gives is empty by its schema."""
    out = anomalies[0].select(*SLOT)
    for a in anomalies[1:]:
        out = out.union(a.select(*SLOT))
    return out.distinct()


def daily_kva_sum(readings: DataFrame, hierarchy: DataFrame, granularity: DataFrame) -> DataFrame:
    """Sum of a meter's slots per day, with DT, location and category; meters without a DT are left out."""
    df = _with_kva(_placed(readings, hierarchy, "DT_CODE_NEW", "SDO_CD", "DT_CAT"), granularity)
    return df.groupBy("MTR_NO", "DT_CODE_NEW", "SDO_CD", "DT_CAT", "DATE").agg(F.sum("KVA").alias("DAILY_KVA_SUM"))


#: Levels and their keys.
_LEVELS = (("DT", "DT_CODE_NEW"), ("FL", "SDO_CD"), ("CAT", "DT_CAT"))


def coincidental_peak_monthly(daily: DataFrame) -> DataFrame:
    """LEVEL, KEY, YEAR, YM, MONTH, PEAK: of a DT the largest daily sum of one of its meters, of a location or category that of all its meters.

    Null keys have no peak; where no slot has a value a location's or category's day counts 0. daily is evaluated once: each of its rows
    goes to its three keys, and the days' sums and maxima are combined before the shuffle.
    """
    keys = F.array(*[F.struct(F.lit(level).alias("LEVEL"), F.col(key).cast("string").alias("KEY")) for level, key in _LEVELS])
    rows = daily.select(F.explode(keys).alias("k"), "DATE", "DAILY_KVA_SUM").select("k.LEVEL", "k.KEY", "DATE", "DAILY_KVA_SUM").where("KEY is not null")
    days = rows.groupBy("LEVEL", "KEY", "DATE").agg(F.max("DAILY_KVA_SUM").alias("one"), F.coalesce(F.sum("DAILY_KVA_SUM"), F.lit(0.0)).alias("all"))
    day = F.when(F.col("LEVEL") == "DT", F.col("one")).otherwise(F.col("all"))
    out = days.groupBy("LEVEL", "KEY", month_of(F.col("DATE")).alias("YM")).agg(F.max(day).alias("PEAK"))
    return out.select("LEVEL", "KEY", F.expr("cast(YM div 100 as int)").alias("YEAR"), "YM", (F.col("YM") % 100).alias("MONTH"), "PEAK")


def coincidental_peak_yearly(monthly: DataFrame) -> DataFrame:
    """The months with their years' maxima beneath, told apart by LEVEL; monthly is evaluated once."""
    year = [F.concat("LEVEL", F.lit("_YEARLY")).alias("LEVEL"), "KEY", "YEAR", *[F.lit(None).cast(monthly.schema[c].dataType).alias(c) for c in ("YM", "MONTH")], "PEAK"]
    both = monthly.select(F.explode(F.array(F.struct("LEVEL", "KEY", "YEAR", "YM", "MONTH", "PEAK"), F.struct(*year))).alias("m")).select("m.*")
    return both.groupBy("LEVEL", "KEY", "YEAR", "YM", "MONTH").agg(F.max("PEAK").alias("PEAK"))


def monthly_peak_raw(readings: DataFrame, hierarchy: DataFrame, granularity: DataFrame) -> DataFrame:
    """A meter's highest slot per month, times its CT ratio."""
    df = _with_kva(_placed(readings, hierarchy, "DT_CODE_NEW", "CT_RATIO"), granularity)
    ym = month_of(F.col("DATE"))
    return df.groupBy("MTR_NO", "DT_CODE_NEW", F.year("DATE").alias("YEAR"), ym.alias("YM")).agg(F.max(F.col("KVA") * F.coalesce("CT_RATIO", F.lit(1.0))).alias("PEAK_KVA_RAW"))


def monthly_peak_clean(raw_peaks: DataFrame, clean: DataFrame, bad: DataFrame, granularity: DataFrame) -> DataFrame:
    """raw_peaks with PEAK_KVA_CLEAN: the highest slot of the clean readings that no anomaly names; null where none is left."""
    good = _with_kva(clean.where("DT_CODE_NEW is not null").join(bad, list(SLOT), "left_anti"), granularity).where("KVA is not null")
    peak = good.groupBy("MTR_NO", month_of(F.col("DATE")).alias("YM")).agg(F.max("KVA").alias("PEAK_KVA_CLEAN"))
    return raw_peaks.select("MTR_NO", "DT_CODE_NEW", "YM", "PEAK_KVA_RAW").join(peak, ["MTR_NO", "YM"], "left")


def monthly_peak_reconstructed(clean: DataFrame, bad: DataFrame, granularity: DataFrame, days: int = 120) -> DataFrame:
    """A meter's highest slot per month, where slots that an anomaly names take the value of a line through the same slot's good values of the
    days before (their mean, if they are of one day; at least 0); with fewer than two of those they stay empty."""
    flagged = clean.where("DT_CODE_NEW is not null").join(bad.withColumn("_bad", F.lit(True)), list(SLOT), "left")
    df = _with_kva(flagged, granularity).withColumn("KVA", F.when(F.col("_bad").isNull(), F.col("KVA"))).withColumn("_x", F.datediff("DATE", F.lit("2020-01-01")).cast("double"))
    past = Window.partitionBy("MTR_NO", "TIME_SLOT").orderBy("_x").rangeBetween(-days, -1)
    line = F.regr_intercept("KVA", "_x").over(past) + F.regr_slope("KVA", "_x").over(past) * F.col("_x")
    filled = F.when(F.count("KVA").over(past) >= 2, F.greatest(F.coalesce(line, F.avg("KVA").over(past)), F.lit(0.0)))
    df = df.withColumn("_filled", F.when(F.col("_bad"), filled))
    return df.groupBy("MTR_NO", month_of(F.col("DATE")).alias("YM")).agg(F.max(F.coalesce("KVA", "_filled")).alias("PEAK_KVA_RECONSTRUCTED"), F.count("_filled").alias("n_filled"))


def peak_delta_kpis(peaks: DataFrame) -> DataFrame:
    """Highest raw and clean peak, the month with the largest difference (the first meter's of equal ones), and the mean difference in percent."""
    delta = F.col("PEAK_KVA_RAW") - F.col("PEAK_KVA_CLEAN")
    rows = peaks.withColumn("delta", delta)
    order = F.when(F.col("delta").isNotNull(), F.struct(F.abs("delta"), -F.col("YM")))
    return rows.agg(F.max("PEAK_KVA_RAW").alias("max_raw"), F.max("PEAK_KVA_CLEAN").alias("max_clean"), F.max(F.abs("delta")).alias("max_delta"), F.max_by("YM", order).alias("max_delta_ym"), F.avg(F.when(F.col("PEAK_KVA_RAW") != 0, F.col("delta") / F.expr("nullif(PEAK_KVA_RAW, 0)") * 100)).alias("mean_delta_pct"))


def pivot_both(peaks: DataFrame, months: list[int]) -> DataFrame:
    """A DT's highest raw and clean peak of each of these months side by side: DT_CODE_NEW, '202401_raw', '202401_clean', ..."""
    return peaks.groupBy("DT_CODE_NEW").pivot("YM", months).agg(F.max("PEAK_KVA_RAW").alias("raw"), F.max("PEAK_KVA_CLEAN").alias("clean"))


def pivot(df: DataFrame, row: str, column: str, values: list, value: str, how: str = "max") -> DataFrame:
    """row by column; `values` fixes the columns and their order."""
    return df.groupBy(row).pivot(column, values).agg(getattr(F, how)(value))
