"""Searching and summing up anomalies by category."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# The seven categories, with the anomaly types of those that hard rules fill.
MISSING, THRESHOLD = "Missing Slots / Days", "Rolling Threshold Spikes (+-5% band)"
HARD_CATEGORIES = {
    "Zero Values (voltage / KWH-with-load)": "ZERO_VOLTAGE|ZERO_KWH_WITH_LOAD",
    "Missing KWH": "MISSING_KWH",
    "Extreme Voltage/Current Spikes": "EXTREME_(VOLTAGE|CURRENT)_.*",
    "Negative KVAR": "NEGATIVE_KVAR_.*",
    "Phase Loss (KW/KVAR)": "PHASE_LOSS_.*",
}


def _category(anomaly_type: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, types in HARD_CATEGORIES.items():
        out = F.when(anomaly_type.rlike(f"^(?:{types})$"), name).otherwise(out)
    return out


def _missing(missing: DataFrame, slot: DataType) -> DataFrame:
    meter = F.col("MTR_NO") if "MTR_NO" in missing.columns else F.lit(None).cast("string")
    return missing.select(meter, "DT_CODE_NEW", "DATE", F.lit(None).cast(slot), F.lit(MISSING), "GAP_TYPE", F.lit(None).cast("string"))


def categorized(hard: DataFrame, threshold: DataFrame, missing: DataFrame) -> DataFrame:
    """All three anomaly tables under one CATEGORY, ANOMALY_TYPE and SEVERITY; missing days have no slot, those of a DT no meter."""
    category = _category(F.col("ANOMALY_TYPE"))
    keys = ["MTR_NO", "DT_CODE_NEW", "DATE", "TIME_SLOT"]
    first = hard.select(*keys, category.alias("CATEGORY"), "ANOMALY_TYPE", "SEVERITY")
    second = threshold.select(*keys, F.lit(THRESHOLD), F.concat_ws("_", "PARAMETER", "DIRECTION"), F.lit(None).cast("string"))
    return first.union(second).union(_missing(missing, hard.schema["TIME_SLOT"].dataType))


def categorized_of(rows: DataFrame, missing: DataFrame) -> DataFrame:
    """categorized of judged readings, which give their hard and threshold anomalies in one explosion."""
    kinds = F.concat(F.transform("HARD", lambda r: F.struct(_category(r["ANOMALY_TYPE"]).alias("CATEGORY"), r["ANOMALY_TYPE"].alias("ANOMALY_TYPE"), r["SEVERITY"].alias("SEVERITY"))), F.transform("BREACHES", lambda r: F.struct(F.lit(THRESHOLD).alias("CATEGORY"), F.concat_ws("_", r["PARAMETER"], r["DIRECTION"]).alias("ANOMALY_TYPE"), F.lit(None).cast("string").alias("SEVERITY"))))
    found = rows.select("MTR_NO", "DT_CODE_NEW", "DATE", "TIME_SLOT", F.inline(kinds))
    return found.union(_missing(missing, rows.schema["TIME_SLOT"].dataType))


def anomaly_search(anomalies: DataFrame, category: str = "All", dt_code: str = "All", meter: str = "All", fl: str = "All", start: dt.date | None = None, end: dt.date | None = None, hierarchy: DataFrame | None = None) -> DataFrame:
    """Anomalies that meet every condition given; 'All' and None set none. fl needs the hierarchy."""
    for column, value in (("CATEGORY", category), ("DT_CODE_NEW", dt_code), ("MTR_NO", meter)):
        if value != "All":
            anomalies = anomalies.where(F.col(column) == value)
    if start is not None:
        anomalies = anomalies.where(F.col("DATE") >= F.lit(start))
    if end is not None:
        anomalies = anomalies.where(F.col("DATE") <= F.lit(end))
    if fl != "All":
        anomalies = anomalies.join(hierarchy.where(F.col("SDO_CD") == fl).select("DT_CODE_NEW").distinct(), "DT_CODE_NEW", "left_semi")
    return anomalies


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    """Per category: anomalies, DTs, meters, those of high or critical severity, and whether it is the most frequent."""
    out = anomalies.groupBy("CATEGORY").agg(F.count("*").alias("n"), F.count_distinct("DT_CODE_NEW").alias("n_dts"), F.count_distinct("MTR_NO").alias("n_meters"), F.count_if(F.col("SEVERITY").isin("HIGH", "CRITICAL")).alias("n_severe"))
    # One row per category, seven at most.
    return out.withColumn("is_top", F.row_number().over(Window.orderBy(F.desc("n"), F.desc("CATEGORY"))) == 1)


def anomaly_types(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("ANOMALY_TYPE").agg(F.count("*").alias("n"))
