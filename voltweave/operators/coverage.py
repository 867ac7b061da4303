"""Which slots of a day are there, and how many there should be."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltweave.constants import SLOTS_15_MINUTES
from voltweave.functions.columns import gap_label

METER, DT = ("MTR_NO", "DT_CODE_NEW"), ("DT_CODE_NEW",)


def daily_slot_counts(readings: DataFrame, keys: tuple[str, ...] = METER) -> DataFrame:
    return readings.groupBy(*keys, "DATE").agg(F.count("*").alias("slots_present"))


def expected_slots(counts: DataFrame, key: str = "MTR_NO") -> DataFrame:
    """The most frequent number of slots a day; of equally frequent ones the lowest."""
    return counts.where("slots_present > 0").groupBy(key).agg(F.mode("slots_present", True).alias("expected_slots_per_day"))


def missing_slot_days(counts: DataFrame, expected: DataFrame, key: str = "MTR_NO") -> DataFrame:
    """Days with fewer slots than expected, how many are missing, and a label."""
    return _labelled(counts.join(expected, key))


def missing_calendar_days(counts: DataFrame, expected: DataFrame, keys: tuple[str, ...] = METER) -> DataFrame:
    """missing_slot_days of calendar_counts, by the first of the keys.

    Joined before the days are laid out: AQE measures what is joined, not what it grows to, and would broadcast a calendar by the size of its spans.
    """
    return _labelled(_laid_out(_spans(counts.join(expected, keys[0]), keys), *keys, extra=("expected_slots_per_day",)))


def _labelled(rows: DataFrame) -> DataFrame:
    out = rows.where("slots_present < expected_slots_per_day")
    return out.withColumns({"missing_slot_count": F.col("expected_slots_per_day") - F.col("slots_present"), "GAP_TYPE": gap_label(F.col("slots_present"), F.col("expected_slots_per_day"))})


def _spans(counts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """counts with NEXT, the key's next day in there; the last day has none."""
    return counts.where("DATE is not null").withColumn("NEXT", F.lead("DATE").over(Window.partitionBy(*keys).orderBy("DATE")))


def _laid_out(spans: DataFrame, *keys: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Spans as days: a span's first day has its slots, those up to the next one have none."""
    days = F.sequence("DATE", F.coalesce(F.date_sub("NEXT", 1), "DATE"))
    rows = spans.select(*keys, *extra, F.col("slots_present").alias("_slots"), F.posexplode(days).alias("_nth", "DATE"))
    return rows.select(*keys, "DATE", F.when(F.col("_nth") == 0, F.col("_slots")).otherwise(F.lit(0)).cast("long").alias("slots_present"), *extra)


def calendar_counts(counts: DataFrame, keys: tuple[str, ...] = METER) -> DataFrame:
    """daily_slot_counts with all days from a key's first to its last: days without a reading have 0 slots.

    Each day with readings lays out the days up to the key's next one, in place: no join, and no row of an empty day is shuffled.
    """
    return _laid_out(_spans(counts, keys), *keys)


def offline_runs(counts: DataFrame, keys: tuple[str, ...] = METER) -> DataFrame:
    """Runs of days without a reading between days with some: first and last day, number of days.

    counts: daily_slot_counts or calendar_counts. Runs are what lies between neighbouring days, so no empty day becomes a row.
    """
    spans = _spans(counts.where("slots_present > 0"), keys).where(F.datediff("NEXT", "DATE") > 1)
    return spans.select(*keys, F.date_add("DATE", 1).alias("first_day"), F.date_sub("NEXT", 1).alias("last_day"), (F.datediff("NEXT", "DATE") - 1).cast("long").alias("n_days"))


def meter_granularity(readings: DataFrame, limit: float = SLOTS_15_MINUTES) -> DataFrame:
    """Minutes of a meter's slots: 15 where its days have more than `limit` slots on average, else 30."""
    mean = daily_slot_counts(readings, ("MTR_NO",)).groupBy("MTR_NO").agg(F.avg("slots_present").alias("n"))
    return mean.select("MTR_NO", F.when(F.col("n") > limit, 15).otherwise(30).alias("SLOT_MINUTES"))
