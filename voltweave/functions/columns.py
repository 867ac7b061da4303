"""Column expressions that several operators share; all run inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltweave.constants import AMPS, KVAR, KW, LOADING_BANDS, VOLTS


def normalize_meter_id(c: Column) -> Column:
    """A meter id as text, without blanks around it or the '.0' that a float leaves."""
    return F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")


def month_of(date: Column) -> Column:
    """yyyymm as an integer."""
    return (F.year(date) * 100 + F.month(date)).cast("int")


def slot_kva(minutes: Column) -> Column:
    """Apparent power of a slot: from volts and amps for 15-minute meters, else from active and reactive power. A null phase makes it null."""
    volt_amps = reduce(lambda a, b: a + b, [F.col(v) * F.col(i) for v, i in zip(VOLTS, AMPS, strict=True)]) / 1000.0
    active, reactive = (reduce(lambda a, b: a + b, [F.col(c) for c in cols]) for cols in (KW, KVAR))
    return F.when(minutes == 15, volt_amps).otherwise(F.sqrt(active * active + reactive * reactive))


def null_count(*cols: str) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in cols])


def loading_band(loading: Column) -> Column:
    """The band's label: lower limits belong to it, upper ones don't; null below the first."""
    out = F.lit(None).cast("string")
    for label, low, high in reversed(LOADING_BANDS):
        out = F.when((loading >= low) & (loading < high) if high is not None else loading >= low, label).otherwise(out)
    return out


def gap_label(present: Column, expected: Column) -> Column:
    return F.when(present == 0, "FULL_DAY_OFFLINE").otherwise(F.concat(F.lit("PARTIAL_"), present.cast("string"), F.lit("_OF_"), expected.cast("string")))
