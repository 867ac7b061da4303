"""Data-quality checks: each gives one row, or one per key, that tells whether an expectation holds."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from voltweave.constants import PARAMETERS, VOLTS
from voltweave.functions.columns import month_of, slot_kva
from voltweave.operators.peaks import SLOT


def anomalies_match(clean: DataFrame, anomalies: DataFrame) -> DataFrame:
    """How many anomalous slots there are, and how many of them are among the clean readings."""
    slots = anomalies.select(*SLOT).distinct()
    found = slots.join(clean.select(*SLOT).distinct().withColumn("there", F.lit(True)), list(SLOT), "left")
    return found.agg(F.count("*").alias("n_slots"), F.count_if("there").alias("n_matched"))


def meters_per_month(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Distinct meters of each month in raw and clean readings."""
    count = lambda df, name: df.groupBy(month_of(F.col("DATE")).alias("YM")).agg(F.count_distinct("MTR_NO").alias(name))
    return count(raw, "raw_meters").join(count(clean, "clean_meters"), "YM", "full").fillna(0)


def months_not_cleaned(raw: DataFrame, clean: DataFrame) -> DataFrame:
    months = lambda df: df.select(month_of(F.col("DATE")).alias("YM"))
    return months(raw).subtract(months(clean))


def nulls_kept(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Per parameter the nulls of raw and clean readings: cleaning only adds some."""
    counts = [df.agg(*[F.count_if(F.col(p).isNull()).alias(p) for p in PARAMETERS]).select(F.expr("stack(" + str(len(PARAMETERS)) + ", " + ", ".join(f"'{p}', `{p}`" for p in PARAMETERS) + f") as (parameter, {name})")) for df, name in ((raw, "raw_nulls"), (clean, "clean_nulls"))]
    return counts[0].join(counts[1], "parameter").withColumn("holds", F.col("clean_nulls") >= F.col("raw_nulls"))


def zero_voltage_nulled(clean: DataFrame) -> DataFrame:
    rows = clean.where("was_zero_voltage")
    left = reduce(lambda a, b: a | b, [F.col(v).isNotNull() for v in VOLTS])
    return rows.agg(F.count("*").alias("n_zero_voltage"), F.count_if(left).alias("n_not_nulled"))


def missing_dt(readings: DataFrame) -> DataFrame:
    """Readings without a DT, and distinct meter-months, DTs and (meter, DT, month) triples."""
    ym = month_of(F.col("DATE"))
    return readings.agg(F.count_if(F.col("DT_CODE_NEW").isNull()).alias("n_null_dt"), F.count_distinct("MTR_NO", ym).alias("meter_months"), F.count_distinct(F.struct("MTR_NO", "DT_CODE_NEW", ym)).alias("meter_dt_months"))


def both_kva(readings: DataFrame) -> DataFrame:
    """Both formulas of apparent power side by side."""
    return readings.select(*SLOT, slot_kva(F.lit(15)).alias("KVA_VI"), slot_kva(F.lit(30)).alias("KVA_PQ"))


def top_slots(readings: DataFrame, anomalies: DataFrame, meter: str, k: int = 5) -> DataFrame:
    """A meter's k highest slots, and whether an anomaly names them."""
    top = both_kva(readings.where(F.col("MTR_NO") == meter)).where("KVA_PQ is not null").orderBy(F.desc("KVA_PQ"), "DATE", "TIME_SLOT").limit(k)
    return top.join(anomalies.select(*SLOT).distinct().withColumn("is_bad", F.lit(True)), list(SLOT), "left").withColumn("is_bad", F.coalesce("is_bad", F.lit(False)))


def key_overlap(left: DataFrame, right: DataFrame, key: str = "MTR_NO") -> DataFrame:
    """Distinct keys on either side, and on both."""
    a, b = left.select(key).distinct().withColumn("l", F.lit(1)), right.select(key).distinct().withColumn("r", F.lit(1))
    return a.join(b, key, "full").agg(F.count("l").alias("n_left"), F.count("r").alias("n_right"), F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("n_both"))


def equal_peaks(peaks: DataFrame) -> DataFrame:
    """Meter-months whose clean peak is the raw one, lower, missing, or (what must not be) higher."""
    raw, clean = F.col("PEAK_KVA_RAW"), F.col("PEAK_KVA_CLEAN")
    return peaks.agg(F.count("*").alias("n"), F.count_if(raw == clean).alias("equal"), F.count_if(clean < raw).alias("lower"), F.count_if(clean.isNull()).alias("missing"), F.count_if(clean > raw).alias("higher"))


def recomputed(cached: DataFrame, fresh: DataFrame, keys: list[str], value: str, tolerance: float = 1e-9) -> DataFrame:
    """Rows of a cached table that a fresh computation doesn't give."""
    both = cached.select(*keys, F.col(value).alias("cached")).join(fresh.select(*keys, F.col(value).alias("fresh")), keys, "full")
    same = F.col("cached").eqNullSafe(F.col("fresh")) | (F.abs(F.col("cached") - F.col("fresh")) <= tolerance)
    return both.agg(F.count("*").alias("n"), F.count_if(~F.coalesce(same, F.lit(False))).alias("n_different"))


def schema_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns that only one of two tables has."""
    rows = [(c, "left") for c in a.columns if c not in b.columns] + [(c, "right") for c in b.columns if c not in a.columns]
    return a.sparkSession.createDataFrame(rows, "column string, side string")


def drift(features: DataFrame, split: str, value: str) -> DataFrame:
    """Mean, sample deviation, minimum and maximum of a value per part of a split."""
    return features.groupBy(split).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))


def unique_placement(hierarchy: DataFrame) -> DataFrame:
    """Meters that the hierarchy places under several DTs: joins on the meter alone would repeat their readings."""
    return hierarchy.groupBy("MTR_NO").agg(F.count_distinct("DT_CODE_NEW").alias("n_dts")).where("n_dts > 1")


def source_files(table: DataFrame, expected: int | None = None) -> DataFrame:
    """Files that a table was read from, its rows, and whether there are as many files as expected."""
    out = table.select(F.col("_metadata.file_path").alias("file")).agg(F.count_distinct("file").alias("n_files"), F.count("*").alias("n_rows"))
    return out if expected is None else out.withColumn("complete", F.col("n_files") == expected)


def columns_of(table: DataFrame) -> DataFrame:
    """Names and types of a table's columns."""
    return table.sparkSession.createDataFrame(table.dtypes, "column_name string, column_type string")


def first_difference(peaks: DataFrame) -> DataFrame:
    """The first meter-month, by month and meter, whose clean peak isn't the raw one."""
    return peaks.where("PEAK_KVA_CLEAN <> PEAK_KVA_RAW").orderBy("YM", "MTR_NO").limit(1)


def ct_ratios(master: DataFrame) -> DataFrame:
    """Per meter its CT ratios over all months: how many, the least and the largest, and rows without one."""
    return master.groupBy("MTR_NO").agg(F.count_distinct("CT_RATIO").alias("n_ratios"), F.min("CT_RATIO").alias("least"), F.max("CT_RATIO").alias("largest"), F.count_if(F.col("CT_RATIO").isNull()).alias("n_without"))


def granularity(readings: DataFrame, minutes: DataFrame) -> DataFrame:
    """Per meter its slots' minutes, readings, days, and readings with a current on the first phase."""
    per_meter = readings.groupBy("MTR_NO").agg(F.count("*").alias("n_rows"), F.count_distinct("DATE").alias("n_days"), F.count("IR").alias("n_current"))
    return per_meter.join(minutes, "MTR_NO", "left")


def observed_counts(rows: DataFrame, stages: dict[str, Callable[[DataFrame], DataFrame]], counted: dict[str, Column] | None = None) -> DataFrame:
    """Rows of each stage of one query that takes rows through all of them, counted while it runs once; counted: conditions for some stages.

    stages: name to what the stage does with the rows of the one before. Observed metrics take no scan or shuffle of their own.
    """
    seen, df = {}, rows
    for name, step in stages.items():
        seen[name] = Observation(name)
        condition = (counted or {}).get(name)
        df = step(df).observe(seen[name], (F.count("*") if condition is None else F.count_if(condition)).alias("n_rows"))
    df.write.format("noop").mode("overwrite").save()
    return rows.sparkSession.createDataFrame([(name, o.get["n_rows"]) for name, o in seen.items()], "stage string, n_rows long")


def staged_counts(**stages: DataFrame) -> DataFrame:
    """Rows of each stage of a query, to see where they are lost."""
    out = None
    for name, df in stages.items():
        part = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("stage"), "n_rows")
        out = part if out is None else out.union(part)
    return out
