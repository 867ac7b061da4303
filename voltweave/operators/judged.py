"""Reports straight from readings: each reading is judged once, and carries what was found instead of being joined to it again."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltweave.constants import HEALTHY_PERCENT, SLOTS_15_MINUTES
from voltweave.functions.columns import month_of, slot_kva
from voltweave.operators import health, rules, sustained, thresholds


def judged(readings: DataFrame, limit: float = SLOTS_15_MINUTES) -> DataFrame:
    """Deduplicated readings with HARD (array of ANOMALY_TYPE, SEVERITY), BREACHES (array of threshold breaches), IS_BAD and SLOT_MINUTES.

    Readings are shuffled once, by meter: its rolling windows and its granularity (15 minutes where its days have more than `limit`
    slots on average) need no other order. After deduplication a meter has at most as many rows as there are slots, so none is hot.
    """
    meter = Window.partitionBy("MTR_NO")
    rows = rules.hard_flags(readings.repartition("MTR_NO")).withColumn("HARD", rules.records()).drop(*rules.rules())
    rows = rows.withColumn("SLOT_MINUTES", F.when(F.count("*").over(meter) > limit * F.size(F.collect_set("DATE").over(meter)), 15).otherwise(30))
    rows = thresholds.with_thresholds(rows).withColumn("BREACHES", thresholds.breaches())
    return rows.select(*readings.columns, "SLOT_MINUTES", "HARD", "BREACHES", (F.size("HARD") + F.size("BREACHES") > 0).alias("IS_BAD"))


def hard_anomalies(rows: DataFrame) -> DataFrame:
    return rows.select("MTR_NO", "DT_CODE_NEW", "DT_CAT", "DATE", "TIME_SLOT", F.inline("HARD"))


def threshold_anomalies(rows: DataFrame) -> DataFrame:
    return rows.select("MTR_NO", "DT_CODE_NEW", "DATE", "TIME_SLOT", F.inline("BREACHES"))


def monthly_peaks(rows: DataFrame) -> DataFrame:
    """MTR_NO, DT_CODE_NEW, YM, PEAK_KVA_RAW, PEAK_KVA_CLEAN of each meter and DT: the highest slot of a month, and of those that no anomaly names.

    A clean peak is the meter's of the month, under whatever DT; null where no good slot has a value. Readings without a DT are left out.
    """
    kva = slot_kva(F.col("SLOT_MINUTES"))
    placed = rows.where("DT_CODE_NEW is not null").select("MTR_NO", "DT_CODE_NEW", month_of(F.col("DATE")).alias("YM"), kva.alias("KVA"), "IS_BAD")
    peaks = placed.groupBy("MTR_NO", "DT_CODE_NEW", "YM").agg(F.max("KVA").alias("PEAK_KVA_RAW"), F.max(F.when(~F.col("IS_BAD"), F.col("KVA"))).alias("own"))
    return peaks.withColumn("PEAK_KVA_CLEAN", F.max("own").over(Window.partitionBy("MTR_NO", "YM"))).drop("own")


def _per_dt(rows: DataFrame) -> DataFrame:
    """Per DT: rows, bad rows, and its kinds of anomaly with their numbers, most first, then by name."""
    names = F.concat(F.transform("HARD", lambda r: r["ANOMALY_TYPE"]), F.transform("BREACHES", lambda r: F.concat_ws("_", r["PARAMETER"], r["DIRECTION"])))
    # A row counts under the empty name, and its kinds under theirs; without a DT there is nothing to list them under.
    known = F.col("DT_CODE_NEW").isNotNull()
    each = rows.select("DT_CODE_NEW", (F.col("IS_BAD") & known).alias("bad"), F.explode(F.concat(F.array(F.lit("")), F.when(known, names).otherwise(F.array().cast("array<string>")))).alias("kind"))
    counts = each.groupBy("DT_CODE_NEW", "kind").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"))
    mine = F.when(F.col("kind") != "", F.struct((-F.col("n")).alias("n"), "kind"))
    total = lambda c: F.sum(F.when(F.col("kind") == "", F.col(c)))
    return counts.groupBy("DT_CODE_NEW").agg(total("n").alias("present_rows"), total("n_bad").alias("bad_rows"), F.array_sort(F.collect_list(mine)).alias("kinds"))


def health_of(rows: DataFrame) -> DataFrame:
    """health.health of judged readings."""
    return health.with_percent(_per_dt(rows)).drop("kinds")


def health_report(rows: DataFrame, least: float = HEALTHY_PERCENT) -> DataFrame:
    """health.health_report of judged readings; at most as many kinds a DT as there are rules and thresholds."""
    out = health.with_percent(_per_dt(rows)).where(F.col("health_pct") >= least)
    text = F.array_join(F.transform("kinds", lambda x: F.concat(x["kind"], F.lit(":"), (-x["n"]).cast("string"))), "; ")
    out = out.withColumns({"top_anomaly_type": F.coalesce(F.get("kinds", F.lit(0))["kind"], F.lit("")), "anomaly_type_breakdown": text}).drop("kinds")
    return out.orderBy(F.desc("health_pct"), "DT_CODE_NEW")


def sustained_daily_clean(rows: DataFrame, ratings: DataFrame) -> DataFrame:
    """sustained.sustained_daily_clean of judged readings: the newest meter's good slots, without the older meter's in place of bad ones."""
    newest = Window.partitionBy("DT_CODE_NEW", "DATE", "TIME_SLOT").orderBy(F.desc(F.coalesce("meter_seq", F.lit(1))), "MTR_NO")
    slots = rows.where("DT_CODE_NEW is not null").select("DT_CODE_NEW", "MTR_NO", "meter_seq", "DATE", "TIME_SLOT", "SLOT_MINUTES", "IS_BAD", slot_kva(F.col("SLOT_MINUTES")).alias("KVA"))
    slots = slots.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1 and not IS_BAD")
    return sustained.band_hours(slots, ratings)
