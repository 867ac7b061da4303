"""A day's load curve: its slots, the band of the week before, gaps and how they are filled, and predictions.

All work on every meter at once; the series of one meter and day are short. Only boosted trees leave the JVM, a meter's half year at a time.
"""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltweave.constants import BOOSTING_DAYS, BOOSTING_ROWS, FIT_WINDOW, LINEAR_GAP, QUADRATIC_GAP, REGRESSION_DAYS
from voltweave.functions.columns import slot_kva

#: Boosted trees: groups of meters in a partition; readings of which the trees are grown at once.
GROUPS, TOGETHER = 4, 20_000


def meter_window(readings: DataFrame, granularity: DataFrame, date: dt.date, days: int = BOOSTING_DAYS) -> DataFrame:
    """Readings of the days up to and with the date, with KVA."""
    rows = readings.where(F.col("DATE").between(F.lit(date - dt.timedelta(days=days)), F.lit(date)))
    return rows.join(granularity, "MTR_NO", "left").withColumn("KVA", slot_kva(F.col("SLOT_MINUTES")))


def active_meters(readings: DataFrame, hierarchy: DataFrame, dt_code: str, date: dt.date) -> DataFrame:
    """Meters of a DT that have readings on the date."""
    there = readings.where(F.col("DATE") == F.lit(date)).select("MTR_NO").distinct()
    return hierarchy.where(F.col("DT_CODE_NEW") == dt_code).select("MTR_NO").distinct().join(there, "MTR_NO", "left_semi")


def slot_grid(window: DataFrame) -> DataFrame:
    """The slots a meter has anywhere in the window, numbered from 0."""
    slots = window.where("TIME_SLOT is not null").select("MTR_NO", "TIME_SLOT").distinct()
    return slots.withColumn("POS", F.row_number().over(Window.partitionBy("MTR_NO").orderBy("TIME_SLOT")) - 1)


def half_hours(spark: SparkSession) -> DataFrame:
    """The grid of a meter without any reading: 48 half hours."""
    return spark.range(48).select(F.format_string("%02d:%02d", F.expr("id div 2"), F.expr("id % 2 * 30")).alias("TIME_SLOT"), F.col("id").cast("int").alias("POS"))


def day_curve(window: DataFrame, grid: DataFrame, param: str, date: dt.date) -> DataFrame:
    """Mean per slot of the date on the whole grid; PRESENT: the slot has a reading. Meters without one on the date have no curve."""
    day = window.where(F.col("DATE") == F.lit(date)).groupBy("MTR_NO", "TIME_SLOT").agg(F.avg(param).alias("ACTUAL"), F.lit(True).alias("PRESENT"))
    rows = grid.join(day.select("MTR_NO").distinct(), "MTR_NO", "left_semi").join(day, ["MTR_NO", "TIME_SLOT"], "left")
    return rows.withColumn("PRESENT", F.coalesce("PRESENT", F.lit(False)))


def threshold_band_7d(window: DataFrame, param: str, date: dt.date, tolerance_pct: float = 5.0) -> DataFrame:
    """Per slot highest, lowest and mean value of the seven calendar days before, and the band around them."""
    week = window.where(F.col("DATE").between(F.lit(date - dt.timedelta(days=7)), F.lit(date - dt.timedelta(days=1))))
    agg = week.groupBy("MTR_NO", "TIME_SLOT").agg(F.max(param).alias("HIST_MAX"), F.min(param).alias("HIST_MIN"), F.avg(param).alias("HIST_MEAN"))
    tol = tolerance_pct / 100.0
    return agg.withColumns({"UPPER_THRESH": F.col("HIST_MAX") * (1 + tol), "LOWER_THRESH": F.col("HIST_MIN") * (1 - tol)})


def band_anomalies(curve: DataFrame, band: DataFrame) -> DataFrame:
    """Slots with a reading and a band: HIGH above it, LOW beneath, else OK."""
    rows = curve.where("PRESENT").select("MTR_NO", "TIME_SLOT", "ACTUAL").join(band, ["MTR_NO", "TIME_SLOT"])
    direction = F.when(F.col("ACTUAL") > F.col("UPPER_THRESH"), "HIGH").when(F.col("ACTUAL") < F.col("LOWER_THRESH"), "LOW").otherwise("OK")
    return rows.withColumn("ANOMALY_DIR", direction).withColumn("IS_ANOMALY", F.col("ANOMALY_DIR") != "OK")


def missing_slot_runs(curve: DataFrame) -> DataFrame:
    """Empty slots with their run, place in it, its length and how it is filled; nothing fills a run at an end of the grid."""
    order = Window.partitionBy("MTR_NO").orderBy("POS")
    rows = curve.withColumn("LAST_POS", F.max("POS").over(Window.partitionBy("MTR_NO")))
    rows = rows.withColumn("RUN", F.count("ACTUAL").over(order)).where("ACTUAL is null")
    run = Window.partitionBy("MTR_NO", "RUN")
    rows = rows.withColumns({"GAP_LENGTH": F.count("*").over(run).cast("int"), "GAP_POSITION": F.row_number().over(run.orderBy("POS"))})
    first, last = F.min("POS").over(run), F.max("POS").over(run)
    method = F.when(F.col("GAP_LENGTH") <= LINEAR_GAP, "linear").when(F.col("GAP_LENGTH") <= QUADRATIC_GAP, "quadratic").otherwise("cubic")
    rows = rows.withColumn("METHOD", F.when((first > 0) & (last < F.col("LAST_POS")), method))
    return rows.select("MTR_NO", "TIME_SLOT", "POS", "GAP_POSITION", "GAP_LENGTH", "METHOD")


def _solved(rows: Column) -> Column:
    """The solution of a tridiagonal system; rows: array of structs a, b, c (below, on and above the diagonal) and d (right side)."""

    def forward(done: Column, r: Column) -> Column:
        above = F.try_element_at(done, F.lit(-1))
        c, d = F.coalesce(above["c"], F.lit(0.0)), F.coalesce(above["d"], F.lit(0.0))
        pivot = r["b"] - r["a"] * c
        return F.concat(done, F.array(F.struct((r["c"] / pivot).alias("c"), ((r["d"] - r["a"] * d) / pivot).alias("d"))))

    swept = F.aggregate(rows, F.array().cast("array<struct<c:double,d:double>>"), forward)
    return F.aggregate(F.reverse(swept), F.array().cast("array<double>"), lambda below, r: F.concat(F.array(r["d"] - r["c"] * F.coalesce(F.get(below, F.lit(0)), F.lit(0.0))), below))


def _points(*at: Column) -> list[tuple[Column, Column]]:
    return [(F.get("_x", i), F.get("_y", i)) for i in at]


def _quadratic_slopes() -> Column:
    """Slopes halfway between points, where a quadratic spline has its knots but for the first and last; there they are the secants'."""
    last = F.size("_x") - 2

    def row(j: Column) -> Column:
        (before, _), (x, y), (right, value), (after, _) = _points(j - 1, j, j + 1, j + 2)
        h, inner = right - x, (j > 0) & (j < last)
        a, c = F.when(inner, h / (4 * (right - before))).otherwise(0.0), F.when(inner, h / (4 * (after - x))).otherwise(0.0)
        return F.struct(a.alias("a"), (1 - a - c).alias("b"), c.alias("c"), ((value - y) / h).alias("d"))

    return _solved(F.transform(F.sequence(F.lit(0), last), row))


def _quadratic(at: Column) -> Column:
    """The value between points _j and _j + 1, by the slope that changes steadily between knots."""
    j, last = F.col("_j"), F.size("_x") - 2
    (x, y), (right, value) = _points(j, j + 1)
    middle, slope = (x + right) / 2, F.get("_m", j)

    def change(piece: Column) -> Column:
        piece = F.least(F.greatest(piece, F.lit(1)), last)
        (low, _), (high, _) = _points(piece - 1, piece + 1)
        return (F.get("_m", piece) - F.get("_m", piece - 1)) / ((high - low) / 2)

    to, back = at - x, right - at
    first = y + slope * to - change(j) * ((middle - x) * to - to * to / 2)
    second = value - slope * back - change(j + 1) * ((right - middle) * back - back * back / 2)
    return F.when(at <= middle, first).otherwise(second)


def _cubic_bends() -> Column:
    """Second derivatives at the points of the cubic spline without knots at the second and the last but one."""
    last = F.size("_x") - 2

    def row(i: Column) -> Column:
        (before, low), (x, y), (right, value) = _points(i - 1, i, i + 1)
        h, k = x - before, right - x
        a, b, c = h, 2 * (h + k), k
        first, end = i == 1, i == last
        b = b + F.when(first, h + h * h / k).otherwise(0.0) + F.when(end, k + k * k / h).otherwise(0.0)
        c = F.when(end, 0.0).otherwise(c - F.when(first, h * h / k).otherwise(0.0))
        a = F.when(first, 0.0).otherwise(a - F.when(end, k * k / h).otherwise(0.0))
        return F.struct(a.alias("a"), b.alias("b"), c.alias("c"), (6 * ((value - y) / k - (y - low) / h)).alias("d"))

    return _solved(F.transform(F.sequence(F.lit(1), last), row))


def _cubic(at: Column) -> Column:
    """The value between points _j and _j + 1; the bends at the ends carry those beside them on."""
    j, last = F.col("_j"), F.size("_x") - 2

    def bend(i: Column) -> Column:
        (a, _), (b, _), (c, _) = _points(F.lit(0), F.lit(1), F.lit(2))
        (e, _), (f, _), (g, _) = _points(last - 1, last, last + 1)
        low, high = (b - a) / (c - b), (g - f) / (f - e)
        start = (1 + low) * F.get("_m", F.lit(0)) - low * F.get("_m", F.lit(1))
        end = (1 + high) * F.get("_m", last - 1) - high * F.get("_m", last - 2)
        return F.when(i == 0, start).when(i == last + 1, end).otherwise(F.get("_m", i - 1))

    (x, y), (right, value) = _points(j, j + 1)
    h, to, back = right - x, at - x, right - at
    curved = bend(j) * (F.pow(back, F.lit(3.0)) / h - h * back) + bend(j + 1) * (F.pow(to, F.lit(3.0)) / h - h * to)
    return (y * back + value * to) / h + curved / 6


def interpolate_gaps(curve: DataFrame, window: int = FIT_WINDOW) -> DataFrame:
    """The curve with FILLED and METHOD: runs of empty slots are filled from the points up to `window` places either side.

    One or two slots by a straight line, three or four by a quadratic spline with knots halfway between points, more by a cubic one without
    knots next to its ends; with too few points by a straight line. Runs at the ends stay empty, filled values don't serve other runs, NaN is
    empty. One exchange, by meter: a curve is a meter's one day, at most 96 slots, and a run's spline has at most twice `window` points, found
    by banded elimination.
    """
    actual = F.nanvl(F.col("ACTUAL").cast("double"), F.lit(None).cast("double"))
    day = Window.partitionBy("MTR_NO")
    rows = curve.withColumn("ACTUAL", actual)
    rows = rows.withColumn("_known", F.array_sort(F.collect_list(F.when(F.col("ACTUAL").isNotNull(), F.struct("POS", "ACTUAL"))).over(day)))
    pos = F.col("POS")
    empty = F.col("ACTUAL").isNull()
    rows = rows.withColumns({"_left": F.when(empty, F.array_max(F.filter("_known", lambda p: p["POS"] < pos))), "_right": F.when(empty, F.array_min(F.filter("_known", lambda p: p["POS"] > pos)))})
    left, right = F.col("_left.POS"), F.col("_right.POS")
    inner = left.isNotNull() & right.isNotNull()
    rows = rows.withColumn("_near", F.when(inner, F.filter("_known", lambda p: (p["POS"] > left - window) & (p["POS"] < right + window))))
    rows = rows.withColumns({"_x": F.transform("_near", lambda p: p["POS"].cast("double")), "_y": F.transform("_near", lambda p: p["ACTUAL"]), "_j": F.size(F.filter("_near", lambda p: p["POS"] <= left)) - 1})
    length, points = right - left - 1, F.size("_near")
    method = F.when((length <= LINEAR_GAP) | (points <= 2), "linear").when(length <= QUADRATIC_GAP, "quadratic").when(points <= 3, "linear").otherwise("cubic")
    rows = rows.withColumn("METHOD", F.when(inner, method))
    rows = rows.withColumn("_m", F.when(F.col("METHOD") == "quadratic", _quadratic_slopes()).when(F.col("METHOD") == "cubic", _cubic_bends()))
    at = pos.cast("double")
    line = F.col("_left.ACTUAL") + (F.col("_right.ACTUAL") - F.col("_left.ACTUAL")) * (at - left) / (right - left)
    filled = F.when(F.col("METHOD") == "linear", line).when(F.col("METHOD") == "quadratic", _quadratic(at)).when(F.col("METHOD") == "cubic", _cubic(at))
    return rows.select(*curve.columns, F.coalesce("ACTUAL", filled).alias("FILLED"), "METHOD")


def interpolate_linear(curve: DataFrame) -> DataFrame:
    """The curve with every inner gap filled by a straight line; stays in the JVM."""
    order = Window.partitionBy("MTR_NO").orderBy("POS")
    known = F.when(F.col("ACTUAL").isNotNull(), F.struct("POS", "ACTUAL"))
    rows = curve.withColumn("_left", F.last(known, True).over(order)).withColumn("_right", F.first(known, True).over(order.rowsBetween(0, Window.unboundedFollowing)))
    step = (F.col("_right.ACTUAL") - F.col("_left.ACTUAL")) / F.expr("nullif(_right.POS - _left.POS, 0)")
    line = F.col("_left.ACTUAL") + step * (F.col("POS") - F.col("_left.POS"))
    return rows.withColumn("FILLED", F.coalesce("ACTUAL", line)).drop("_left", "_right")


def regression_curve(window: DataFrame, grid: DataFrame, param: str, date: dt.date, days: int = REGRESSION_DAYS) -> DataFrame:
    """Per slot the line through the values of the days before, at the date, not under 0. With fewer than two values the meter's median; no row without history."""
    past = window.where((F.col("DATE") >= F.lit(date - dt.timedelta(days=days))) & (F.col("DATE") < F.lit(date)) & F.col(param).isNotNull())
    past = past.withColumn("_x", F.datediff("DATE", F.lit(date)).cast("double"))
    line = past.groupBy("MTR_NO", "TIME_SLOT").agg(F.count("*").alias("_n"), F.coalesce(F.regr_intercept(param, "_x"), F.avg(param)).alias("_fit"))
    median = past.groupBy("MTR_NO").agg(F.median(param).alias("_median"))
    rows = grid.select("MTR_NO", "TIME_SLOT").join(line, ["MTR_NO", "TIME_SLOT"], "left").join(median, "MTR_NO")
    return rows.select("MTR_NO", "TIME_SLOT", F.when(F.col("_n") >= 2, F.greatest(F.col("_fit"), F.lit(0.0))).otherwise(F.col("_median")).alias("PREDICTED"))


def boost(x: np.ndarray, y: np.ndarray, at: np.ndarray, rounds: int = 150, depth: int = 4, step: float = 0.08, share: float = 0.85) -> np.ndarray:
    """Predictions at the rows of `at` by gradient-boosted regression trees for squared errors, each grown on a sample of the rows."""
    return boost_each([(x, y, at)], rounds, depth, step, share)[0]


def boost_each(series: list[tuple[np.ndarray, np.ndarray, np.ndarray]], rounds: int = 150, depth: int = 4, step: float = 0.08, share: float = 0.85) -> list[np.ndarray]:
    """boost of each (x, y, at) on its own, all at once: what NumPy spends on a call is shared.

    The trees of all series grow level by level: one histogram over (node, feature, value) for all their nodes. Features with one value can't split.
    """
    rngs, trained = [np.random.default_rng(42) for _ in series], [len(y) for _, y, _ in series]
    ends, asked = np.cumsum(trained), np.cumsum([len(at) for _, _, at in series])
    rows, values = int(ends[-1]), np.concatenate([y for _, y, _ in series])
    owner = np.concatenate([np.repeat(np.arange(len(series)), trained), np.repeat(np.arange(len(series)), np.diff(asked, prepend=0))])
    fit = np.array([y.mean() for _, y, _ in series])[owner]
    varied = [j for j in range(series[0][0].shape[1]) if any((x[:, j] != x[0, j]).any() for x, _, _ in series)]
    known = [[np.unique(x[:, j]) for j in varied] for x, _, _ in series]
    # Codes of a row of `at`: how many cuts, halfway between two values, it is above.
    codes = [np.array([np.searchsorted(v, x[:, j]) for v, j in zip(k, varied, strict=True)], int).reshape(len(varied), len(x)).T for (x, _, _), k in zip(series, known, strict=True)]
    codes += [np.array([np.searchsorted((v[:-1] + v[1:]) / 2, at[:, j]) for v, j in zip(k, varied, strict=True)], int).reshape(len(varied), len(at)).T for (_, _, at), k in zip(series, known, strict=True)]
    codes, many, width = np.concatenate(codes), len(varied), max((len(v) for k in known for v in k), default=1)
    bins = codes[:rows] + np.arange(many) * width

    def grow(some: np.ndarray, rest: np.ndarray) -> None:
        """Adds a tree; some: the sample, ordered by node, bounds: where each node's begins and ends, live: rows that are in no leaf yet, node: theirs."""
        bounds, live, node = np.concatenate(([0], np.searchsorted(some, ends))), np.arange(len(fit)), owner
        for level in range(depth if many else 0, -1, -1):
            r, size = rest[some], np.diff(bounds)
            total = np.array([r[a:b].sum() for a, b in zip(bounds, bounds[1:], strict=False)])
            split = np.zeros(len(size), bool)
            if level:
                keys = (bins[some] + np.repeat(np.arange(len(size)) * (many * width), size)[:, None]).ravel()
                shape = (len(size), many, width)
                n = np.bincount(keys, minlength=math.prod(shape)).reshape(shape).cumsum(2).reshape(len(size), -1)
                left = np.bincount(keys, np.repeat(r, many), math.prod(shape)).reshape(shape).cumsum(2).reshape(len(size), -1)
                ok = (n > 0) & (n < size[:, None])
                gain = left**2 / np.maximum(n, 1) + (total[:, None] - left) ** 2 / np.maximum(size[:, None] - n, 1) - (total**2 / np.maximum(size, 1))[:, None]
                gain[~ok] = -1.0
                best = gain.argmax(1)
                split = gain[np.arange(len(size)), best] > 1e-12
            if not split.all():
                leaf = ~split[node]
                fit[live[leaf]] += (step * (total / np.maximum(size, 1)))[node[leaf]]
                if not split.any():
                    return
                live, node = live[~leaf], node[~leaf]
            feature, cut = np.divmod(best, width)
            first = 2 * (np.cumsum(split) - 1)
            at_node = np.repeat(np.arange(len(size)), size)
            child = np.where(split, first, -2)[at_node] + (codes[some, feature[at_node]] > cut[at_node])
            order = np.argsort(child, kind="stable")[int((child < 0).sum()) :]
            some, bounds = some[order], np.concatenate(([0], np.bincount(child[order]).cumsum()))
            node = first[node] + (codes[live, feature[node]] > cut[node])

    for _ in range(rounds):
        grow(np.flatnonzero(np.concatenate([rng.random(n) for rng, n in zip(rngs, trained, strict=True)]) < share), values - fit[:rows])
    return np.split(fit[rows:], asked[:-1])


def boosted_curves(window: DataFrame, grid: DataFrame, param: str, date: dt.date, rounds: int = 150) -> DataFrame:
    """Every meter's curve by gradient-boosted trees of its own over ten calendar features, not under 0.

    With fewer than 50 values in the 180 days before, or equal ones, regression_curve. TIME_SLOT is 'HH:MM', or the number of a
    slot of which the grid holds a day. A group is a few meters' half years, of some ten thousand slots each at most.
    """
    past = window.where((F.col("DATE") >= F.lit(date - dt.timedelta(days=BOOSTING_DAYS))) & (F.col("DATE") < F.lit(date)) & F.col(param).isNotNull())
    kinds = past.groupBy("MTR_NO").agg((F.count("*") >= BOOSTING_ROWS) & (F.stddev_pop(param) >= 1e-10)).toDF("MTR_NO", "_boosted").where("_boosted").select("MTR_NO")
    clock = grid.schema["TIME_SLOT"].dataType.simpleString() == "string"

    def features(df: pd.DataFrame) -> np.ndarray:
        day = pd.to_datetime(df["DATE"])
        hour = df["TIME_SLOT"].str[:2].astype(int) if clock else df["TIME_SLOT"]
        minute = df["TIME_SLOT"].str[3:5].astype(int) if clock else 0 * hour
        columns = [hour, minute, day.dt.weekday, day.dt.month, day.dt.day, (day - pd.Timestamp(1970, 1, 1)).dt.days + dt.date(1970, 1, 1).toordinal()]
        turns = [f(2 * math.pi * c / size) for c, size in ((hour, 24), (day.dt.weekday, 7)) for f in (np.sin, np.cos)]
        return np.stack([np.asarray(c, float) for c in columns + turns], 1)

    def run(slots: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        slots = slots[slots["MTR_NO"].isin(rows["_meter"])].sort_values(["MTR_NO", "TIME_SLOT"]) if len(rows) else slots.iloc[:0]
        if not len(slots):
            return slots[["MTR_NO", "TIME_SLOT"]].assign(PREDICTED=0.0)
        rows = rows.set_axis(["_part", "MTR_NO", "DATE", "TIME_SLOT", param], axis=1).sort_values(["MTR_NO", "DATE", "TIME_SLOT", param])
        cut = [np.flatnonzero(df["MTR_NO"].to_numpy()[1:] != df["MTR_NO"].to_numpy()[:-1]) + 1 for df in (rows, slots)]
        x, y, at = np.split(features(rows), cut[0]), np.split(rows[param].to_numpy(float), cut[0]), np.split(features(slots.assign(DATE=date)), cut[1])
        series, found, first = list(zip(x, y, at, strict=True)), [], 0
        before = np.cumsum([0, *map(len, y)])
        while first < len(series):
            end = max(first + 1, int(np.searchsorted(before, before[first] + TOGETHER, "right")) - 1)
            found += boost_each(series[first:end], rounds)
            first = end
        return slots[["MTR_NO", "TIME_SLOT"]].assign(PREDICTED=np.maximum(np.concatenate(found), 0.0))

    schema = f"MTR_NO string, TIME_SLOT {grid.schema['TIME_SLOT'].dataType.simpleString()}, PREDICTED double"
    asked = past.where("TIME_SLOT is not null").join(kinds, "MTR_NO", "left_semi").select("MTR_NO", "DATE", "TIME_SLOT", param).toDF("_meter", "_date", "_slot", "_value")
    # A meter's few kilobytes take long, so AQE may not merge these partitions by their bytes; of a partition's meters a GROUPS-th are grown together.
    parts = int(window.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(GROUPS * parts)).alias("_part")
    slots = grid.select(part("MTR_NO"), "MTR_NO", "TIME_SLOT").repartition(parts, "_part")
    asked = asked.select(part("_meter").alias("_asked"), "*").repartition(parts, "_asked")
    made = slots.groupBy("_part").cogroup(asked.groupBy("_asked")).applyInPandas(run, schema)
    others = regression_curve(window.join(kinds, "MTR_NO", "left_anti"), grid.join(kinds, "MTR_NO", "left_anti"), param, date, BOOSTING_DAYS)
    return made.unionByName(others)


def predicted_by(method: str, window: DataFrame, grid: DataFrame, param: str, date: dt.date, rounds: int = 150) -> DataFrame | None:
    """What clean_curve takes from: nothing for 'Off', regression_curve for 'Regression', boosted_curves for 'Boosting' and 'Auto'.

    boosted_curves gives a meter with a short history the regression's curve, so 'Auto' is decided meter by meter.
    """
    if method == "Off":
        return None
    if method == "Regression":
        return regression_curve(window, grid, param, date)
    if method in ("Boosting", "Auto"):
        return boosted_curves(window, grid, param, date, rounds)
    raise ValueError(f"no such method: {method}")


def clean_curve(filled: DataFrame, flagged: DataFrame, predicted: DataFrame | None) -> DataFrame:
    """FILLED with the prediction in the anomalous slots, where there is one; None leaves it as it is."""
    if predicted is None:
        return filled.withColumn("CLEAN", F.col("FILLED"))
    bad = flagged.where("IS_ANOMALY").select("MTR_NO", "TIME_SLOT").join(predicted, ["MTR_NO", "TIME_SLOT"])
    return filled.join(bad, ["MTR_NO", "TIME_SLOT"], "left").withColumn("CLEAN", F.coalesce("PREDICTED", "FILLED")).drop("PREDICTED")


def curve_slope(curve: DataFrame, value: str = "ACTUAL") -> DataFrame:
    return curve.withColumn("SLOPE", F.col(value) - F.lag(value).over(Window.partitionBy("MTR_NO").orderBy("POS")))


def curve_kpis(curve: DataFrame, flagged: DataFrame, band: DataFrame) -> DataFrame:
    """Per meter: peak, anomalous and missing slots, and the band's outer limits."""
    base = curve.groupBy("MTR_NO").agg(F.max("ACTUAL").alias("peak"), F.count_if(F.col("ACTUAL").isNull()).alias("n_missing"))
    bad = flagged.groupBy("MTR_NO").agg(F.count_if("IS_ANOMALY").alias("n_anomalies"))
    limits = band.groupBy("MTR_NO").agg(F.max("UPPER_THRESH").alias("max_upper"), F.min("LOWER_THRESH").alias("min_lower"))
    return base.join(bad, "MTR_NO", "left").join(limits, "MTR_NO", "left").withColumn("n_anomalies", F.coalesce("n_anomalies", F.lit(0)))
