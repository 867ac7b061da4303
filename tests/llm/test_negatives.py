"""Hard negatives: brute force over all pairs, bands, repeated rows and ids, odd components."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltweave.llm import negatives
from voltweave.llm.negatives import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, anchor, positives=5, n_negatives=10, low=30, high=90):
    kept = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows if i is not None and y is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, y, v) in enumerate(kept):
        if not anchor(i):
            continue
        scores = sorted((-sum(p * q for p, q in zip(v, w, strict=True)), j, b, z) for b, (j, z, w) in enumerate(kept) if b != a and len(w) == len(v))
        for score, j, _, _ in [s for s in scores if s[3] == y][:positives]:
            fits = [s for s in scores if s[3] != y and low * -score <= 100 * -s[0] <= high * -score]
            out += [(i, j, r, s[1], -score, -s[0]) for r, s in enumerate(fits[:n_negatives], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def mined(spark, rows, step, **settings):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for c in ("v", "id", "row", "pid", "block", "part", "cell", "pivot", "dist", "r", "anchor"):
        df = df.withColumn(c, F.lit("clash"))
    return hard_negatives(df, F.col("vec_id") % step == 0, F.col("label"), **settings)


@pytest.fixture
def small_units(monkeypatch):
    """Several cells, blocks and parts, and a sample that knows few of the rows."""
    for name, value in (("CELL", 4), ("BLOCK", 3), ("PART", 1), ("SAMPLE", 30), ("PIVOTS", 5)):
        monkeypatch.setattr(negatives, name, value)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_equal_to_brute_force(spark, small_units, spread):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 8))
    rows = [(i, int(rng.integers(0, 4)) if i % 50 else 9, (centres[i % 6] + spread * rng.normal(size=8)).tolist()) for i in range(400)]
    assert found(mined(spark, rows, 10)) == brute(rows, lambda i: i % 10 == 0)


def test_a_wide_first_radius_is_not_needed(spark, small_units, monkeypatch):
    monkeypatch.setattr(negatives, "MARGIN", 0)
    rng = np.random.default_rng(8)
    rows = [(i, i % 3, rng.normal(size=4).tolist()) for i in range(200)]
    assert found(mined(spark, rows, 20)) == brute(rows, lambda i: i % 20 == 0)


def test_a_common_vector_repeated_ids_and_odd_rows(spark, small_units):
    rng = np.random.default_rng(9)
    rows = [(i, i % 2, [0.5, 0.25, 0.25]) for i in range(0, 300, 2)] + [(i, i % 3, rng.normal(size=3).tolist()) for i in range(1, 300, 2)]
    rows += [(10, 0, [0.5, 0.25, 0.25]), (10, 0, [0.4, 0.3, 0.2]), (10, 1, [0.4, 0.3, 0.2]), (600, None, [1.0, 1.0, 1.0]), (610, 1, None), (620, 1, []), (630, 1, [1.0, None, 0.0])]
    rows += [(640, 1, [math.nan, 0.0, 0.0]), (650, 1, [math.inf, 0.0, 0.0]), (None, 1, [1.0, 1.0, 1.0]), (660, 1, [1.0, 0.5]), (670, 1, [1.0, 0.25]), (671, 0, [0.5, 0.5]), (-20, 1, [0.0, 0.0, 0.0]), (-21, 1, [0.0, 0.0, 0.0]), (-22, 0, [0.0, 0.0, 0.0])]
    assert found(mined(spark, rows, 10)) == brute(rows, lambda i: i % 10 == 0)


def test_large_components_are_exact(spark, small_units):
    rng = np.random.default_rng(10)
    rows = [(i, i % 2, (rng.normal(size=3) * 40_000).tolist()) for i in range(80)]
    assert found(mined(spark, rows, 8, positives=3, negatives=4, low=10, high=95)) == brute(rows, lambda i: i % 8 == 0, 3, 4, 10, 95)


def test_empty_tables(spark):
    empty = mined(spark, [(1, 1, [1.0])], 10)
    assert empty.count() == 0 and mined(spark, [], 10).columns == empty.columns
    assert mined(spark, [(10, 1, [1.0]), (20, 2, [1.0])], 10).count() == 0
