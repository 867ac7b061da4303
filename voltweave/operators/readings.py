"""From raw readings to a month's scaled readings with their place in the hierarchy."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltweave.constants import AMPS, ENERGY, KVAR, KW, LOOKBACK_DAYS
from voltweave.functions.columns import month_of, null_count


def month_window(ym: int) -> tuple[int, dt.date, dt.date, dt.date]:
    """The month before, the month's first and last day, and the first day of its lookback."""
    year, month = divmod(ym, 100)
    first = dt.date(year, month, 1)
    after = dt.date(year + month // 12, month % 12 + 1, 1)
    before = first - dt.timedelta(days=1)
    return before.year * 100 + before.month, first, after - dt.timedelta(days=1), first - dt.timedelta(days=LOOKBACK_DAYS)


def raw_dedup(readings: DataFrame, tie: str = "event_id", ym: int | None = None) -> DataFrame:
    """One row per meter, date and slot: the one with the fewest nulls, then the smallest `tie`. ym: that month and its lookback only."""
    if ym is not None:
        _, _, last, start = month_window(ym)
        readings = readings.where(F.col("DATE").between(F.lit(start), F.lit(last)))
    best = Window.partitionBy("MTR_NO", "DATE", "TIME_SLOT").orderBy(null_count("VR", "IR", ENERGY), tie)
    return readings.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")


def master_periods(master: DataFrame) -> DataFrame:
    """The master as periods: each (meter, month) row, the first by DT code where it repeats, is valid up to the meter's next month."""
    one = Window.partitionBy("MTR_NO", "MONTH").orderBy(F.asc_nulls_last("DT_CODE_NEW"), *[F.asc_nulls_last(c) for c in master.columns if c not in ("MTR_NO", "MONTH", "DT_CODE_NEW")])
    rows = master.withColumn("_rank", F.row_number().over(one)).where("_rank = 1").drop("_rank")
    return rows.withColumn("MONTH_TO", F.lead("MONTH").over(Window.partitionBy("MTR_NO").orderBy("MONTH")))


def asof_master(readings: DataFrame, master: DataFrame, ym: Column | None = None) -> DataFrame:
    """Readings with the master row of the latest month not after theirs; null columns where there is none.

    An equi-join on the meter with a range test on the month: no nested loop. Columns of readings that the master also has are replaced.
    """
    cols = [c for c in master.columns if c not in ("MTR_NO", "MONTH")]
    left = readings.drop(*cols).withColumn("_ym", month_of(F.col("DATE")) if ym is None else ym).alias("r")
    m = master_periods(master).alias("m")
    on = (F.col("r.MTR_NO") == F.col("m.MTR_NO")) & (F.col("_ym") >= F.col("m.MONTH")) & (F.col("m.MONTH_TO").isNull() | (F.col("_ym") < F.col("m.MONTH_TO")))
    return left.join(m, on, "left").select("r.*", *[F.col(f"m.{c}") for c in cols]).drop("_ym")


def asof_master_join(readings: DataFrame, master: DataFrame, earliest: DataFrame, sequence: DataFrame) -> DataFrame:
    """asof_master, filled from each meter's earliest master row, with the meter's place in its DT's replacement chain."""
    cols = [c for c in ("DT_CODE_NEW", "SDO_CD", "CT_RATIO", "DT_CAT") if c in master.columns]
    joined = asof_master(readings, master.select("MTR_NO", "MONTH", *cols)).alias("a").join(earliest.alias("e"), F.col("a.MTR_NO") == F.col("e.MTR_NO"), "left")
    filled = joined.select("a.*", *[F.col(f"e.{c}").alias(f"_{c}") for c in cols]).withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in cols}).drop(*[f"_{c}" for c in cols])
    out = filled.drop("meter_seq", "dt_meter_rank", "is_meter_replaced").join(sequence.select("MTR_NO", "DT_CODE_NEW", "meter_seq", "dt_meter_rank", "is_meter_replaced"), ["MTR_NO", "DT_CODE_NEW"], "left")
    return out.withColumn("is_meter_replaced", F.coalesce("is_meter_replaced", F.lit(False)))


def ct_scaling(readings: DataFrame, enabled: bool = True) -> DataFrame:
    """Current, power and energy times the CT ratio (1 if there is none); volts as they are. ct_scaled tells where a ratio was known."""
    if not enabled:
        return readings.withColumn("ct_scaled", F.lit(False))
    ct = F.coalesce(F.col("CT_RATIO"), F.lit(1.0))
    scaled = {c: F.expr(f"try_cast(`{c}` as double)") * ct for c in (*AMPS, *KW, *KVAR, ENERGY) if c in readings.columns}
    return readings.withColumns(scaled | {"ct_scaled": F.col("CT_RATIO").isNotNull()})


def base_month(readings: DataFrame, ym: int) -> DataFrame:
    _, first, last, _ = month_window(ym)
    return readings.where(F.col("DATE").between(F.lit(first), F.lit(last)))


def dt_stitched_readings(readings: DataFrame) -> DataFrame:
    """One row per DT, date and slot: the newest meter's, even where its values are null; ties go to the smaller meter id."""
    newest = Window.partitionBy("DT_CODE_NEW", "DATE", "TIME_SLOT").orderBy(F.desc(F.coalesce("meter_seq", F.lit(1))), "MTR_NO")
    return readings.where("DT_CODE_NEW is not null").withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
