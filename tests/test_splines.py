"""Gaps filled in the JVM against splines of NumPy: basis functions and a dense system."""

import numpy as np
import pytest

from voltweave.operators import curve


def _basis(knots: np.ndarray, degree: int, i: int, x: np.ndarray) -> np.ndarray:
    """Cox-de Boor's recursion for the i-th B-spline."""
    if degree == 0:
        inside = (knots[i] <= x) & (x < knots[i + 1])
        return (inside | ((x == knots[-1]) & (knots[i] < knots[i + 1]) & (knots[i + 1] == knots[-1]))).astype(float)
    out = np.zeros(len(x))
    if knots[i + degree] > knots[i]:
        out += (x - knots[i]) / (knots[i + degree] - knots[i]) * _basis(knots, degree - 1, i, x)
    if knots[i + degree + 1] > knots[i + 1]:
        out += (knots[i + degree + 1] - x) / (knots[i + degree + 1] - knots[i + 1]) * _basis(knots, degree - 1, i + 1, x)
    return out


def spline(x: np.ndarray, y: np.ndarray, at: np.ndarray, degree: int) -> np.ndarray:
    """The interpolating spline of degree 2 or 3 through the points, at places between them. Cubic: no knot next to the ends; quadratic: knots halfway between points."""
    inner = x[2:-2] if degree == 3 else ((x[1:] + x[:-1]) / 2)[1:-1]
    knots = np.concatenate([[x[0]] * (degree + 1), inner, [x[-1]] * (degree + 1)])
    matrix = lambda p: np.stack([_basis(knots, degree, i, p) for i in range(len(x))], 1)
    return matrix(at) @ np.linalg.solve(matrix(x), y)


def fill_gaps(values: np.ndarray, window: int = 6) -> tuple[np.ndarray, list[str | None]]:
    """Fills runs of NaN inside the series from up to `window` places either side, by their length: linear, quadratic or cubic.

    Runs at the ends stay. With too few points for a method, linear. Filled values don't serve other runs.
    """
    filled, methods = values.copy(), [None] * len(values)
    known = np.flatnonzero(~np.isnan(values))
    for left, right in zip(known[:-1], known[1:], strict=True):
        gap = np.arange(left + 1, right)
        if not len(gap):
            continue
        near = known[(known > left - window) & (known < right + window)]
        degree = 1 if len(gap) <= 2 else 2 if len(gap) <= 4 else 3
        if len(near) <= degree:
            degree = 1
        filled[gap] = np.interp(gap, near, values[near]) if degree == 1 else spline(near.astype(float), values[near], gap.astype(float), degree)
        for i in gap:
            methods[i] = ("linear", "quadratic", "cubic")[degree - 1]
    return filled, methods


def filled(spark, series):
    """The operator's (values, methods) of each series; NaN for what stays empty."""
    rows = [(m, i, i, None if np.isnan(v) else float(v), "x") for m, values in series.items() for i, v in enumerate(values)]
    out = {m: ([None] * len(v), [None] * len(v)) for m, v in series.items()}
    for r in curve.interpolate_gaps(spark.createDataFrame(rows, "MTR_NO string, TIME_SLOT int, POS int, ACTUAL double, EXTRA string")).collect():
        out[r["MTR_NO"]][0][r["POS"]], out[r["MTR_NO"]][1][r["POS"]] = r["FILLED"], r["METHOD"]
    return out


def same(values, wanted):
    return all((v is None and np.isnan(w)) or (v is not None and v == pytest.approx(w, rel=1e-9, abs=1e-8)) for v, w in zip(values, wanted, strict=True))


def test_random_gaps_equal_numpy(spark):
    rng, series = np.random.default_rng(4), {}
    for k in range(60):
        values = rng.normal(size=rng.integers(1, 60)).cumsum() * 10
        for _ in range(rng.integers(0, 6)):
            first = rng.integers(0, len(values))
            values[first : first + rng.integers(1, 10)] = np.nan
        series[f"M{k}"] = values
    found, kinds = filled(spark, series), set()
    for m, values in series.items():
        wanted, methods = fill_gaps(values)
        assert same(found[m][0], wanted) and found[m][1] == methods
        kinds |= set(methods)
    assert kinds == {None, "linear", "quadratic", "cubic"}


def test_polynomials_ends_and_few_points(spark):
    nan, x = float("nan"), np.arange(24.0)
    series, wanted = {}, {}
    for degree, gap in ((1, 1), (1, 2), (2, 3), (2, 4), (3, 5), (3, 6)):
        y = (x - 7) ** degree
        wanted[f"{degree}{gap}"] = y
        series[f"{degree}{gap}"] = np.where((x >= 9) & (x < 9 + gap), nan, y)
    series |= {"ends": np.array([nan, 1.0, nan, 2.0, nan]), "few": np.array([1.0, nan, nan, nan, 5.0]), "three": np.array([1.0, 4.0] + [nan] * 5 + [49.0]), "none": np.array([nan, nan])}
    wanted |= {"ends": np.array([nan, 1.0, 1.5, 2.0, nan]), "few": np.arange(1.0, 6), "three": np.array([1.0, 4.0, 11.5, 19.0, 26.5, 34.0, 41.5, 49.0]), "none": np.array([nan, nan])}
    found = filled(spark, series)
    assert all(same(found[m][0], w) for m, w in wanted.items())
    assert [found[f"{d}{g}"][1][9] for d, g in ((1, 1), (2, 3), (3, 5))] == ["linear", "quadratic", "cubic"] and found["three"][1][3] == "linear"


def test_one_exchange_and_no_python(spark):
    day = spark.createDataFrame([("A", i, i, None if i in (3, 4, 5) else 1.0 * i) for i in range(10)], "MTR_NO string, TIME_SLOT int, POS int, ACTUAL double")
    plan = curve.interpolate_gaps(day)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1 and "Pandas" not in plan
