"""Calendar days: laid out after every join, and compared with plain Python."""

import datetime as dt
import os

import pytest

from voltweave.operators import coverage
from voltweave.plans.queries import _QUERIES, Tables

DATA = "/root/testdata/sf0.001"
DAY = dt.timedelta(days=1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sparse(spark):
    """Days with readings of meters, two of them with few in many years, one without a transformer, one with a single day."""
    first = dt.date(2001, 3, 1)
    days = {("A", "D1"): {0: 4, 1: 4, 3000: 2}, ("A", "D2"): {7: 4, 9: 1}, ("B", None): {5: 2, 6000: 2}, ("C", "D1"): {3: 9}, ("D", "D3"): {i * i: 1 + i % 3 for i in range(60)}}
    rows = [(m, d, first + n * DAY, k) for (m, d), at in days.items() for n, k in at.items()]
    return rows, spark.createDataFrame([*rows, ("A", "D1", None, 3)], "MTR_NO string, DT_CODE_NEW string, DATE date, slots_present long")


def laid_out(rows):
    found = {}
    for m, d, day, k in rows:
        found.setdefault((m, d), {})[day] = k
    return {(*key, min(at) + n * DAY): at.get(min(at) + n * DAY, 0) for key, at in found.items() for n in range((max(at) - min(at)).days + 1)}


def test_calendar_days_equal_plain_python(sparse):
    rows, counts = sparse
    wanted = laid_out(rows)
    assert {(r[0], r[1], r[2]): r[3] for r in coverage.calendar_counts(counts).collect()} == wanted
    expected = coverage.expected_slots(counts.where("DATE is not null"))
    most = {r[0]: r[1] for r in expected.collect()}
    found = coverage.missing_calendar_days(counts, expected).collect()
    assert {(r["MTR_NO"], r["DT_CODE_NEW"], r["DATE"]): r["slots_present"] for r in found} == {k: n for k, n in wanted.items() if n < most[k[0]]}
    assert all(r["missing_slot_count"] == most[r["MTR_NO"]] - r["slots_present"] for r in found) and len(found) > 9000


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_no_join_sees_laid_out_days(spark):
    text = plan(_QUERIES["missing_slot_days_calendar"](Tables(spark, DATA)))
    # A plan is written from its top: days are laid out above every join, and once.
    assert text.count("Generate ") == 1 and text.index("Generate ") < text.index("Join ")


def test_runs_are_found_between_days(sparse):
    rows, counts = sparse
    wanted, days = set(), {}
    for m, d, day, _ in rows:
        days.setdefault((m, d), []).append(day)
    for key, at in days.items():
        at.sort()
        wanted |= {(*key, a + DAY, b - DAY, (b - a).days - 1) for a, b in zip(at, at[1:], strict=False) if b - a > DAY}
    runs = coverage.offline_runs(counts)
    assert {tuple(r) for r in runs.collect()} == wanted == {tuple(r) for r in coverage.offline_runs(coverage.calendar_counts(counts)).collect()}
    assert "Generate " not in plan(runs) and "Join " not in plan(runs)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_offline_runs_lay_out_no_days(spark):
    assert "Generate " not in plan(_QUERIES["offline_runs"](Tables(spark, DATA)))
