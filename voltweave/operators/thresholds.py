"""Readings outside the band of a slot's own recent history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltweave.constants import BAND, LOOKBACK_DAYS, PARAMETERS, ROLLING_ROWS
from voltweave.functions.columns import month_of


def _high(p: str) -> Column:
    return F.col(p) > F.col(f"{p}_HI") * (1 + BAND)


def _low(p: str) -> Column:
    return (F.col(f"{p}_LO") > 0) & (F.col(p) < F.col(f"{p}_LO") * (1 - BAND))


def with_thresholds(readings: DataFrame) -> DataFrame:
    """Readings with the highest and lowest value of the seven rows before in the same meter and slot, for 13 parameters, as <parameter>_HI and _LO.

    A month sees its own rows and those of the seven days before it, so rows near a month's end take part in two months; each
    reading comes out once, as its own month judges it. All parameters share one window, so readings are read and shuffled once, and not
    at all where they are partitioned by meter.
    """
    own = month_of(F.col("DATE"))
    following = F.add_months(F.trunc("DATE", "month"), 1)
    months = F.when(F.col("DATE") >= F.date_sub(following, LOOKBACK_DAYS), F.array(own, month_of(following))).otherwise(F.array(own))
    rows = readings.withColumn("EVAL_YM", F.explode(months))
    before = Window.partitionBy("EVAL_YM", "MTR_NO", "TIME_SLOT").orderBy("DATE").rowsBetween(-ROLLING_ROWS, -1)
    rows = rows.withColumns({f"{p}_{name}": f(p).over(before) for p in PARAMETERS for name, f in (("HI", F.max), ("LO", F.min))})
    return rows.where(own == F.col("EVAL_YM"))


def rolling_thresholds(readings: DataFrame) -> DataFrame:
    """The rows of with_thresholds with a breach; EVAL_YM is the month they are judged in."""
    breach = reduce(lambda a, b: a | b, [F.coalesce(_high(p) | _low(p), F.lit(False)) for p in PARAMETERS])
    return with_thresholds(readings.select("MTR_NO", "DT_CODE_NEW", "DATE", "TIME_SLOT", *PARAMETERS)).where(breach)


def breaches() -> Column:
    """Array of a row's breaches: PARAMETER, VALUE, THRESH_HI, THRESH_LO, DIRECTION; a value above the band counts before one below."""

    def record(p: str) -> Column:
        direction = F.when(_high(p), "HIGH").when(_low(p), "LOW")
        return F.struct(F.lit(p).alias("PARAMETER"), F.col(p).alias("VALUE"), F.col(f"{p}_HI").alias("THRESH_HI"), F.col(f"{p}_LO").alias("THRESH_LO"), direction.alias("DIRECTION"))

    return F.filter(F.array(*[record(p) for p in PARAMETERS]), lambda r: r["DIRECTION"].isNotNull())


def threshold_anomalies(thresholds: DataFrame) -> DataFrame:
    """One row per breach."""
    return thresholds.select("MTR_NO", "DT_CODE_NEW", "DATE", "TIME_SLOT", F.inline(breaches()))
