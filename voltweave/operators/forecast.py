"""Yearly forecasts by the model with the least leave-one-out error, from power sums: no row leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METHODS = ("linear", "quadratic", "exponential")
#: Values that an exponential is fitted to are at least this.
FLOOR = 1e-6
LEAST_YEARS = 4


def _line(s: list[Column], t: list[Column], x: Column) -> Column:
    """The least-squares line at x, from the sums of powers s of the years and t of those times the values."""
    slope = F.try_divide(s[0] * t[1] - s[1] * t[0], s[0] * s[2] - s[1] * s[1])
    return F.try_divide(t[0] - slope * s[1], s[0]) + slope * x


def _parabola(s: list[Column], t: list[Column], x: Column) -> Column:
    """The least-squares parabola at x, by the cofactors of its normal equations."""
    c00, c01, c02 = s[2] * s[4] - s[3] * s[3], s[2] * s[3] - s[1] * s[4], s[1] * s[3] - s[2] * s[2]
    c11, c12, c22 = s[0] * s[4] - s[2] * s[2], s[1] * s[2] - s[0] * s[3], s[0] * s[2] - s[1] * s[1]
    top = (c00 * t[0] + c01 * t[1] + c02 * t[2]) + (c01 * t[0] + c11 * t[1] + c12 * t[2]) * x + (c02 * t[0] + c12 * t[1] + c22 * t[2]) * x * x
    return F.try_divide(top, s[0] * c00 + s[1] * c01 + s[2] * c02)


def _fits(s: list[Column], t: list[Column], u: list[Column], x: Column) -> list[Column]:
    """All methods' predictions at x; t: sums with the values, u: with their logarithms."""
    return [_line(s, t, x), _parabola(s, t, x), F.exp(_line(s, u, x))]


def forecasts(yearly: DataFrame, key: str = "DT_CODE_NEW", value: str = "YEARLY_PEAK", target: int = 2027) -> DataFrame:
    """Per key with four years or more: METHOD, FORECAST, LOO_ERROR, the last year's peak, and growth against it. A key has one row per year.

    Every year is predicted by the fits to the other years, whose power sums are the key's less the year's own; the method with the
    least mean squared error is fitted to all years. Ties go to the simpler method; errors that aren't finite don't count. Years are centred per
    key, which leaves predictions as they are. Null and NaN values are left out; a last year without a value leaves CURRENT_PEAK null.
    One exchange, by key.
    """
    everything = Window.partitionBy(key)
    y = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    rows = yearly.select(key, F.col("YEAR").cast("double").alias("year"), y.alias("y")).withColumn("centre", F.avg(F.when(F.col("y").isNotNull(), F.col("year"))).over(everything))
    rows = rows.withColumns({"x": F.when(F.col("y").isNotNull(), F.col("year") - F.col("centre")), "ln": F.when(F.col("y").isNotNull(), F.log(F.greatest(F.col("y"), F.lit(FLOOR))))})
    x, y, ln = F.col("x"), F.col("y"), F.col("ln")
    one = F.when(x.isNotNull(), F.lit(1.0))
    terms = {f"s{i}": v for i, v in enumerate((one, x, x * x, x * x * x, x * x * x * x))} | {f"t{i}": v for i, v in enumerate((y, y * x, y * x * x))} | {f"u{i}": v for i, v in enumerate((ln, ln * x))}
    rows = rows.withColumns(terms).withColumns({f"all_{name}": F.sum(name).over(everything) for name in terms})
    others = lambda name, n: [F.col(f"all_{name}{i}") - F.col(f"{name}{i}") for i in range(n)]
    errors = {f"e{i}": F.pow(p - y, F.lit(2.0)) for i, p in enumerate(_fits(others("s", 5), others("t", 3), others("u", 2), x))}
    sums = rows.withColumns(errors).groupBy(key).agg(
        F.count("y").alias("n"), F.max_by("y", "year").alias("CURRENT_PEAK"), F.max("centre").alias("centre"),
        *[F.avg(F.coalesce(F.when(y.isNotNull(), F.col(e)), F.when(y.isNotNull(), F.lit(float("inf"))))).alias(e) for e in errors], *[F.max(f"all_{name}").alias(name) for name in terms],
    )
    full = lambda name, n: [F.col(f"{name}{i}") for i in range(n)]
    fits = _fits(full("s", 5), full("t", 3), full("u", 2), F.lit(float(target)) - F.col("centre"))
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (c < float("inf"))
    tried = F.array(*[F.when(finite(F.col(f"e{i}")), F.struct(F.col(f"e{i}").alias("error"), F.lit(i).alias("turn"), F.lit(name).alias("method"), fits[i].alias("forecast"))) for i, name in enumerate(METHODS)])
    out = sums.where(F.col("n") >= LEAST_YEARS).withColumn("best", F.array_min(tried)).where("best is not null")
    out = out.select(key, F.col("best.method").alias("METHOD"), F.col("best.forecast").alias("FORECAST"), F.col("best.error").alias("LOO_ERROR"), "CURRENT_PEAK")
    growth = F.when(F.col("CURRENT_PEAK") > 0, (F.try_divide("FORECAST", "CURRENT_PEAK") - 1) * 100).otherwise(F.lit(0.0))
    return out.withColumn("GROWTH_PCT", growth)


def fl_forecast(dt_forecasts: DataFrame, places: DataFrame) -> DataFrame:
    """Sum of the DTs' forecasts and current peaks per location, highest first; places: DT_CODE_NEW, SDO_CD."""
    rows = dt_forecasts.join(places.select("DT_CODE_NEW", "SDO_CD").distinct(), "DT_CODE_NEW")
    out = rows.groupBy("SDO_CD").agg(F.sum("FORECAST").alias("FORECAST"), F.sum("CURRENT_PEAK").alias("CURRENT_PEAK"), F.count("*").alias("n_dts"))
    return out.orderBy(F.desc("FORECAST"), "SDO_CD")
