"""Hard rules: flags per reading, the same as a list of anomalies, and the readings without what is flagged."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltweave.constants import AMPS, ENERGY, EXEMPT_CATEGORIES, I_MAX, KVAR, KVAR_MIN, KW, PHASE_LOSS_KVAR, PHASE_LOSS_KW, V_MAX, V_MIN, VOLTS

_KEYS = ("MTR_NO", "DT_CODE_NEW", "DT_CAT", "DATE", "TIME_SLOT")


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def rules() -> dict[str, tuple[Column, str, str]]:
    """flag: condition, name of the anomaly, severity. Conditions on nulls stay null."""
    counts = F.col("DT_CAT").isNull() | ~F.col("DT_CAT").isin(*EXEMPT_CATEGORIES)
    out = {"f_zero_v": (reduce(lambda a, b: a & b, [F.col(c) == 0 for c in VOLTS]), "ZERO_VOLTAGE", "HIGH")}
    for c in VOLTS:
        out[f"f_ext_v_{c.lower()}"] = (counts & (F.col(c) > 0) & ((F.col(c) < V_MIN) | (F.col(c) > V_MAX)), f"EXTREME_VOLTAGE_{c}", "HIGH")
    for c in AMPS:
        out[f"f_ext_i_{c.lower()}"] = (counts & (F.col(c) > I_MAX), f"EXTREME_CURRENT_{c}", "CRITICAL")
    out["f_missing_kwh"] = (F.col(ENERGY).isNull() & F.col("VR").isNotNull() & (F.col("VR") > 0), "MISSING_KWH", "MEDIUM")
    out["f_zero_kwh_load"] = ((F.col(ENERGY) == 0) & _any([F.col(c) > 0 for c in AMPS]), "ZERO_KWH_WITH_LOAD", "HIGH")
    for c in KVAR:
        out[f"f_neg_{c.lower()}"] = (F.col(c) < KVAR_MIN, f"NEGATIVE_KVAR_{c}", "LOW")
    for phases, eps in ((KW, PHASE_LOSS_KW), (KVAR, PHASE_LOSS_KVAR)):
        for c in phases:
            alive = _any([F.abs(o) > eps for o in phases if o != c])
            out[f"f_ploss_{c.lower()}"] = ((F.abs(c) <= eps) & alive, f"PHASE_LOSS_{c}", "HIGH")
    return out


def hard_flags(readings: DataFrame) -> DataFrame:
    """Readings with 18 nullable flags; one projection."""
    return readings.withColumns({flag: condition for flag, (condition, _, _) in rules().items()})


def records() -> Column:
    """Array of a row's true flags: ANOMALY_TYPE and SEVERITY."""
    every = F.array(*[F.when(F.col(f), F.struct(F.lit(name).alias("ANOMALY_TYPE"), F.lit(severity).alias("SEVERITY"))) for f, (_, name, severity) in rules().items()])
    return F.filter(every, lambda r: r.isNotNull())


def hard_anomalies(flags: DataFrame) -> DataFrame:
    """One row per true flag: ANOMALY_TYPE and SEVERITY. The flags are read once."""
    return flags.select(*_KEYS, F.inline(records()))


def clean_readings(flags: DataFrame) -> DataFrame:
    """Readings whose flagged values are null: all volts at zero voltage, else an extreme or negative value itself. Power and energy stay."""
    cleaned = {}
    for c in VOLTS:
        cleaned[c] = F.when(F.col("f_zero_v") | F.col(f"f_ext_v_{c.lower()}"), None).otherwise(F.col(c))
    for c in AMPS:
        cleaned[c] = F.when(F.col(f"f_ext_i_{c.lower()}"), None).otherwise(F.col(c))
    for c in KVAR:
        cleaned[c] = F.when(F.col(f"f_neg_{c.lower()}"), None).otherwise(F.col(c))
    return flags.withColumns(cleaned).withColumn("was_zero_voltage", F.col("f_zero_v")).drop(*rules())
