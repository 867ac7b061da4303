"""Hours that transformers spend in bands of loading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltweave.constants import LOADING_BANDS, SUSTAINED_HOURS
from voltweave.functions.columns import loading_band, month_of, slot_kva
from voltweave.operators.peaks import SLOT


def dt_rating(hierarchy: DataFrame) -> DataFrame:
    return hierarchy.where("DT_CODE_NEW is not null").groupBy("DT_CODE_NEW").agg(F.max("KVA_RATING").alias("DT_KVA_RATING"))


def band_hours(slots: DataFrame, ratings: DataFrame) -> DataFrame:
    """slots: DT_CODE_NEW, DATE, SLOT_MINUTES, KVA. Loading under the first band, or without a rating, has no hours."""
    df = slots.join(ratings, "DT_CODE_NEW").withColumn("loading", F.col("KVA") / F.expr("nullif(DT_KVA_RATING, 0)"))
    df = df.where(F.col("loading") >= LOADING_BANDS[0][1]).withColumn("BAND", loading_band(F.col("loading")))
    return df.groupBy("DT_CODE_NEW", F.year("DATE").alias("YEAR"), month_of(F.col("DATE")).alias("YM"), "DATE", "BAND").agg(F.sum(F.col("SLOT_MINUTES") / 60.0).alias("hours_in_band"))


def sustained_daily_raw(readings: DataFrame, placement: DataFrame, granularity: DataFrame, ratings: DataFrame) -> DataFrame:
    """Hours per DT, day and band of the sum over its meters; placement: MTR_NO, DT_CODE_NEW, one row per meter."""
    df = readings.drop("DT_CODE_NEW").join(placement.where("DT_CODE_NEW is not null").select("MTR_NO", "DT_CODE_NEW"), "MTR_NO").join(granularity, "MTR_NO", "left")
    slots = df.groupBy("DT_CODE_NEW", "DATE", "TIME_SLOT", "SLOT_MINUTES").agg(F.sum(slot_kva(F.col("SLOT_MINUTES"))).alias("KVA"))
    return band_hours(slots, ratings)


def sustained_daily_clean(clean: DataFrame, bad: DataFrame, granularity: DataFrame, ratings: DataFrame) -> DataFrame:
    """Hours per DT, day and band of its newest meter; a slot that an anomaly names is empty, not the older meter's."""
    newest = Window.partitionBy("DT_CODE_NEW", "DATE", "TIME_SLOT").orderBy(F.desc(F.coalesce("meter_seq", F.lit(1))), "MTR_NO")
    df = clean.where("DT_CODE_NEW is not null").withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
    df = df.join(bad.select(*SLOT), list(SLOT), "left_anti").join(granularity, "MTR_NO", "left")
    return band_hours(df.withColumn("KVA", slot_kva(F.col("SLOT_MINUTES"))), ratings)


def band_hours_monthly(daily: DataFrame) -> DataFrame:
    return daily.groupBy("DT_CODE_NEW", "YEAR", "YM", "BAND").agg(F.sum("hours_in_band").alias("hours_in_band"))


def sustained_flag(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn("is_sustained", F.col("hours_in_band") >= SUSTAINED_HOURS)


def sustained_kpis(monthly: DataFrame) -> DataFrame:
    """DTs, hours, mean hours of a DT, DTs with 30 hours over all months and bands, and DTs with 30 in one month and band."""
    per_dt = monthly.groupBy("DT_CODE_NEW").agg(F.sum("hours_in_band").alias("h"), F.max("hours_in_band").alias("most"))
    many: Column = F.count_if(F.col("h") >= SUSTAINED_HOURS)
    return per_dt.agg(F.count("*").alias("n_dts"), F.sum("h").alias("hours"), F.avg("h").alias("avg_hours"), many.alias("sustained_dts"), F.count_if(F.col("most") >= SUSTAINED_HOURS).alias("sustained_month_dts"))
