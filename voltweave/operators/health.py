"""Data health: the share of a transformer's readings that no anomaly names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltweave.constants import HEALTHY_PERCENT

_KEYS = ("DT_CODE_NEW", "MTR_NO", "DATE", "TIME_SLOT")


def health(readings: DataFrame, hard: DataFrame, threshold: DataFrame) -> DataFrame:
    """Per DT: present, bad and clean rows and health_pct, to one decimal."""
    bad = hard.select(*_KEYS).union(threshold.select(*_KEYS)).distinct().withColumn("is_bad", F.lit(True))
    per_dt = readings.select(*_KEYS).join(bad, list(_KEYS), "left").groupBy("DT_CODE_NEW").agg(F.count("*").alias("present_rows"), F.count_if(F.col("is_bad")).alias("bad_rows"))
    return with_percent(per_dt)


def with_percent(per_dt: DataFrame) -> DataFrame:
    """present_rows and bad_rows with clean_rows and their share, to one decimal."""
    clean = F.col("present_rows") - F.col("bad_rows")
    return per_dt.withColumns({"clean_rows": clean, "health_pct": F.round(F.lit(100.0) * clean / F.expr("nullif(present_rows, 0)"), 1)})


def _percent():
    return F.lit(100.0) * F.col("clean_rows") / F.expr("nullif(present_rows, 0)")


def health_report(readings: DataFrame, hard: DataFrame, threshold: DataFrame, least: float = HEALTHY_PERCENT) -> DataFrame:
    """DTs of at least `least` percent (as rounded), with their most frequent anomaly and all of them, most first, then by name."""
    kinds = hard.select("DT_CODE_NEW", "ANOMALY_TYPE").union(threshold.select("DT_CODE_NEW", F.concat_ws("_", "PARAMETER", "DIRECTION")))
    counts = kinds.groupBy("DT_CODE_NEW", "ANOMALY_TYPE").agg(F.count("*").alias("n"))
    # At most as many kinds as there are rules and thresholds, so the list stays short.
    listed = counts.groupBy("DT_CODE_NEW").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), F.col("ANOMALY_TYPE").alias("kind")))).alias("k"))
    text = F.array_join(F.transform("k", lambda x: F.concat(x["kind"], F.lit(":"), (-x["n"]).cast("string"))), "; ")
    listed = listed.select("DT_CODE_NEW", F.col("k")[0]["kind"].alias("top_anomaly_type"), text.alias("anomaly_type_breakdown"))
    out = health(readings, hard, threshold).where(F.col("health_pct") >= least).join(listed, "DT_CODE_NEW", "left")
    return out.fillna("", ["top_anomaly_type", "anomaly_type_breakdown"]).orderBy(F.desc("health_pct"), "DT_CODE_NEW")


def health_distribution(report: DataFrame) -> DataFrame:
    """DTs in six classes of health, not rounded."""
    p = _percent()
    bucket = F.when(p >= 95, "95-100%").when(p >= 90, "90-95%").when(p >= 75, "75-90%").when(p >= 50, "50-75%").when(p >= 25, "25-50%").otherwise("0-25%")
    return report.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n_dts"))


def health_span(readings: DataFrame, report: DataFrame, limit: float = 75.0) -> DataFrame:
    """Below and above the limit: DTs, and their mean number of days with readings and of days from first to last."""
    span = readings.groupBy("DT_CODE_NEW").agg(F.count_distinct("DATE").alias("days"), F.datediff(F.max("DATE"), F.min("DATE")).alias("span"))
    side = F.when(_percent() < limit, "below").otherwise("above")
    return report.join(span, "DT_CODE_NEW").groupBy(side.alias("side")).agg(F.count("*").alias("n_dts"), F.avg("days").alias("avg_days"), F.avg("span").alias("avg_span"))


def total_dts(readings: DataFrame) -> DataFrame:
    return readings.agg(F.count_distinct("DT_CODE_NEW").alias("total_dts"))
