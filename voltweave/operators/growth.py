"""Yearly peaks and their growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def yearly_peak(monthly: DataFrame, key: str = "DT_CODE_NEW", value: str = "PEAK_KVA_RAW") -> DataFrame:
    return monthly.where(F.col(key).isNotNull()).groupBy(key, F.expr("cast(YM div 100 as int)").alias("YEAR")).agg(F.max(value).alias("YEARLY_PEAK"))


def yoy_growth(yearly: DataFrame, key: str = "DT_CODE_NEW") -> DataFrame:
    """Percent against the last year that is there; null for the first, and after a peak of 0."""
    before = F.lag("YEARLY_PEAK").over(Window.partitionBy(key).orderBy("YEAR"))
    return yearly.withColumn("_before", before).withColumn("YOY_PCT", (F.try_divide("YEARLY_PEAK", "_before") - 1) * 100).drop("_before")


def growth_kpis(growth: DataFrame) -> DataFrame:
    return growth.agg(F.avg("YOY_PCT").alias("avg_yoy"), F.max("YOY_PCT").alias("max_yoy"), F.min("YOY_PCT").alias("min_yoy"), F.count_distinct("YEAR").alias("n_years"))


def compound_growth(yearly: DataFrame, key: str = "DT_CODE_NEW") -> DataFrame:
    """Compound annual growth from the first to the last year; null with one year, or from a peak that isn't positive."""
    ends = yearly.groupBy(key).agg(F.min("YEAR").alias("first_year"), F.max("YEAR").alias("last_year"), F.min_by("YEARLY_PEAK", "YEAR").alias("first_peak"), F.max_by("YEARLY_PEAK", "YEAR").alias("last_peak"))
    grown = F.when((F.col("first_peak") > 0) & (F.col("last_year") > F.col("first_year")), (F.pow(F.col("last_peak") / F.expr("nullif(first_peak, 0)"), 1 / F.expr("nullif(last_year - first_year, 0)")) - 1) * 100)
    return ends.withColumn("CAGR_PCT", grown)
