"""Forecasts against NumPy's fits, each year left out in turn."""

import numpy as np
import pytest

from voltweave.operators import forecast

METHODS = forecast.METHODS


def predict(method, years, values, at):
    x, t = years - years.mean(), at - years.mean()
    if method == "exponential":
        return float(np.exp(np.polyval(np.polyfit(x, np.log(np.maximum(values, 1e-6)), 1), t)))
    return float(np.polyval(np.polyfit(x, values, METHODS.index(method) + 1), t))


def best(years, values, target):
    ok = ~np.isnan(values)
    years, values = years[ok], values[ok]
    if len(years) < 4:
        return None
    errors = [np.mean([(predict(m, np.delete(years, i), np.delete(values, i), years[i]) - values[i]) ** 2 for i in range(len(years))]) for m in METHODS]
    method = METHODS[int(np.argmin(errors))]
    return method, predict(method, years, values, target), min(errors)


def rows_of(spark, series, target=2027):
    rows = [(k, y, v) for k, points in series.items() for y, v in points]
    df = spark.createDataFrame(rows, "DT_CODE_NEW string, YEAR int, YEARLY_PEAK double")
    return {r["DT_CODE_NEW"]: r for r in forecast.forecasts(df, target=target).collect()}


def test_equal_to_numpy(spark):
    rng = np.random.default_rng(3)
    shapes = (lambda x: 50 + 3 * x, lambda x: 20 + x * x / 3, lambda x: 9 * np.exp(x / 4), lambda x: 40 + 0 * x)
    series = {}
    for k in range(40):
        years = np.sort(rng.choice(np.arange(2005, 2026), rng.integers(3, 12), replace=False))
        values = shapes[k % 4](years - 2010.0) * rng.uniform(0.9, 1.1, len(years))
        series[f"D{k}"] = [(int(y), None if rng.random() < 0.05 else float(v)) for y, v in zip(years, values, strict=True)]
    found = rows_of(spark, series)
    wanted = {k: best(np.array([y for y, _ in p], float), np.array([np.nan if v is None else v for _, v in p]), 2027) for k, p in series.items()}
    assert set(found) == {k for k, w in wanted.items() if w}
    assert {r["METHOD"] for r in found.values()} == set(METHODS)
    for k, r in found.items():
        method, value, error = wanted[k]
        assert r["METHOD"] == method and r["FORECAST"] == pytest.approx(value, rel=1e-8) and r["LOO_ERROR"] == pytest.approx(error, rel=1e-7)
        assert r["CURRENT_PEAK"] == series[k][-1][1]


def test_four_years_zeros_and_nan(spark):
    found = rows_of(spark, {"three": [(2020, 1.0), (2021, 2.0), (2022, 3.0)], "nan": [(2019, float("nan")), (2020, 1.0), (2021, 2.0), (2022, 3.0)], "zero": [(y, 0.0) for y in range(2019, 2024)], "last": [(2018, 5.0), (2019, 7.0), (2020, 8.0), (2021, 12.0), (2022, None)]})
    assert set(found) == {"zero", "last"}
    assert found["zero"]["FORECAST"] == pytest.approx(0.0, abs=1e-5) and found["zero"]["GROWTH_PCT"] == 0.0
    assert found["last"]["CURRENT_PEAK"] is None


def test_one_exchange_and_no_python(spark):
    df = spark.createDataFrame([("A", y, float(y % 5)) for y in range(2010, 2020)], "DT_CODE_NEW string, YEAR int, YEARLY_PEAK double")
    plan = forecast.forecasts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1 and "Pandas" not in plan
