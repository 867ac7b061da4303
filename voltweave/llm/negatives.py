"""Hard-negative mining over one-dimensional distance keys.

Every vector gets one more component, sqrt(M^2 - |v|^2) with M the largest norm, and a query a zero, so that the highest inner products are the
nearest neighbours: |q - v|^2 = |q|^2 + M^2 - 2 q.v. A stored vector's key is its nearest pivot and its distance to it, and the table lies
sorted by (pivot, distance), in cells of CELL rows. By the triangle inequality all vectors within r of a query have keys within r of the
query's own distance to their pivot, so a search scans key intervals around each pivot and widens them. What hasn't been scanned is farther
than r; once that bound is below the k-th score found, the k are final. A search can be restricted to a band of scores, which begins at an
annulus, and to the label of the query or to others.

Rows of equal vector and label have equal scores, so the table holds them once, with as many of their smallest ids as a search can
return; one very common vector is one row. Searches are taken in blocks of neighbouring queries; a task scores about 16 cells against
one block. Pivots and first radii come from a sample of SAMPLE vectors; they steer how much is scanned, never what is found.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, small_batches, staged

PIVOTS, SAMPLE, ROUNDS = 32, 2048, 8
#: Rows of a cell, and queries of a block, as powers of two; cells that are scored together, likewise.
CELL, BLOCK, PART = 9, 10, 4
#: Scores held at once: queries of a slice times rows of a part.
SLICE = 64
#: How many times k rows the first radius should hold, going by the sample.
MARGIN = 4
#: Squared distances are sure to this part of |q|^2 + M^2, and keys to the root of that.
SURE = 1e-11
_LOWEST, _HIGHEST = -(2**62), 2**62


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of the rows, exact: in float64 as long as no sum can pass 2^53, else in int64."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1] < 2**53:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return q @ c.T


class Space:
    """What every task knows of the vectors of one length: the largest squared norm, the pivots and the sample."""

    def __init__(self, most: float, n: int, sample: np.ndarray, labels: np.ndarray):
        self.most, self.n, self.sample, self.labels = most, n, sample, labels
        points = self.augmented(sample)
        pivots = points[np.linspace(0, len(points) - 1, min(PIVOTS, len(points))).astype(int)]
        for _ in range(ROUNDS):
            nearest = self.distances(points, pivots).argmin(1)
            for j in np.unique(nearest):
                pivots[j] = points[nearest == j].mean(0)
        self.pivots = pivots

    def augmented(self, v: np.ndarray) -> np.ndarray:
        v = v.astype(np.float64)
        return np.concatenate([v, np.sqrt(np.maximum(0.0, self.most - (v * v).sum(1)))[:, None]], 1)

    def asked(self, v: np.ndarray) -> np.ndarray:
        return np.concatenate([v.astype(np.float64), np.zeros((len(v), 1))], 1)

    @staticmethod
    def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T))

    def norm(self, v: np.ndarray) -> np.ndarray:
        """|q|^2 + M^2."""
        return (v.astype(np.float64) ** 2).sum(1) + self.most

    def slack(self, v: np.ndarray) -> np.ndarray:
        """By how much a squared distance can be wrong."""
        return SURE * self.norm(v) + 1e-9

    def radius(self, v: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Distance, rounded up, of vectors of this score."""
        return np.sqrt(np.maximum(0.0, self.norm(v) - 2.0 * score) + self.slack(v))


def _key(space: Space):
    def run(batches):
        for b in batches:
            if len(b):
                d = space.distances(space.augmented(np.stack(b["v"].to_list())), space.pivots)
                yield b.assign(pivot=d.argmin(1).astype(np.int32), dist=d.min(1))

    return run


def _begin(space: Space, k: int):
    """Probes with their distances to the pivots and a first radius that, going by the sample, holds MARGIN * k rows."""
    want = max(1, -(-MARGIN * k * len(space.sample) // max(1, space.n)))

    def run(batches):
        for b in batches:
            for i in range(0, len(b), SLICE):
                p = b.iloc[i : i + SLICE]
                if not len(p):
                    continue
                v = np.stack(p["v"].to_list())
                d = space.distances(space.asked(v), space.pivots)
                scores, low, high = products(v, space.sample), p["low"].to_numpy(), p["high"].to_numpy()
                fits = (scores >= low[:, None]) & (scores <= high[:, None]) & ((space.labels[None] == p["label"].to_numpy()[:, None]) == p["same"].to_numpy()[:, None])
                ranked = np.sort(np.where(fits, scores, _LOWEST), 1)[:, ::-1]
                best = ranked[:, min(want, ranked.shape[1]) - 1]
                far = np.where(low > _LOWEST, space.radius(v, low.astype(float)), np.inf)
                near = np.sqrt(np.maximum(0.0, space.radius(v, high.astype(float)) ** 2 - 2 * space.slack(v)))
                reach = d.max(1) + 2 * np.sqrt(space.most) + 1.0
                first = np.where((fits.sum(1) >= want), space.radius(v, best.astype(float)), np.inf)
                yield p.assign(home=d.argmin(1).astype(np.int32), at=d.min(1), d=list(d), near=np.where(high < _HIGHEST, near, 0.0), target=np.minimum(far, reach), old=-1.0, r=np.minimum(np.minimum(first, far), reach), norm=space.norm(v), pad=2 * np.sqrt(SURE * space.norm(v)) + 1e-6)

    return run


def _interval(d: np.ndarray, near: np.ndarray, r: np.ndarray, pad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys that vectors between near and r of a query can have at a pivot in distance d; empty before the first scan (r < 0)."""
    return np.where(r < 0, np.inf, np.maximum(d - r, near - d) - pad), np.where(r < 0, -np.inf, d + r + pad)


def _scan(k: int):
    """A block's probes against some cells: of what lies in the new key intervals, each probe's k best rows."""

    def run(key, probes: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(probes) and len(held):
            c, pivot, dist, label = np.stack(held["v"].to_list()), held["pivot"].to_numpy(), held["dist"].to_numpy(), held["label"].to_numpy()
            owner = np.repeat(np.arange(len(held)), held["ids"].map(len))
            ids, rows = (np.concatenate(held[name].to_list()) for name in ("ids", "rows"))
            for i in range(0, len(probes), SLICE):
                p = probes.iloc[i : i + SLICE]
                scores, d = products(np.stack(p["q"].to_list()), c), np.stack(p["d"].to_list())[:, pivot]
                near, r, old, pad = (p[name].to_numpy()[:, None] for name in ("near", "r", "old", "pad"))
                (lo, hi), (lo_old, hi_old) = _interval(d, near, r, pad), _interval(d, near, old, pad)
                ok = (dist >= lo) & (dist <= hi) & ~((dist >= lo_old) & (dist <= hi_old))
                ok &= (scores >= p["low"].to_numpy()[:, None]) & (scores <= p["high"].to_numpy()[:, None])
                ok &= (label[None] == p["asked_label"].to_numpy()[:, None]) == p["same"].to_numpy()[:, None]
                for pid, own, s, fits in zip(p["pid"], p["own"], scores, ok, strict=True):
                    at = np.flatnonzero(fits[owner] & (rows != own))
                    if len(at) > k:
                        s_at = s[owner[at]]
                        at = at[s_at >= np.partition(s_at, len(at) - k)[len(at) - k]]
                    at = at[np.lexsort((rows[at], ids[at], -s[owner[at]]))[:k]]
                    found += [(pid, int(s[owner[j]]), int(ids[j]), int(rows[j])) for j in at]
        return pd.DataFrame(found, columns=["pid", "score", "id", "row"]).astype("int64")

    return run


def _numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df written in this order, with `number`, each row's place from 0."""
    placed = staged(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each partition of the table, however many rows it has.
    starts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    out = placed.join(F.broadcast(starts), part == F.col("_part")).withColumn("number", F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1))
    out = out.drop("_at", "_part", "_start")
    out.staged_path = placed.staged_path
    return out


class Index:
    """Vectors of one length, stored sorted by (pivot, distance); keep: how many rows of equal vector and label a search can return."""

    def __init__(self, rows: DataFrame, keep: int):
        alike = Window.partitionBy("label", "v").orderBy("id", "row")
        first = rows.withColumn("_turn", F.row_number().over(alike)).where(F.col("_turn") <= keep)
        groups = first.groupBy("label", "v").agg(F.array_sort(F.collect_list(F.struct("id", "row"))).alias("m"))
        groups = staged(groups.select("label", "v", F.col("m.id").alias("ids"), F.col("m.row").alias("rows")), "groups")
        norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
        most, n = groups.agg(F.max(norm), F.count("*")).first()
        # A bounded sample, the same at every run: the vectors of the smallest hashes.
        sample = groups.orderBy(F.xxhash64("v", "label"), "v", "label").limit(SAMPLE).select("label", "v").toPandas()
        self.space = Space(most, n, np.stack(sample["v"].to_list()), sample["label"].to_numpy())
        keyed = groups.mapInPandas(_key(self.space), f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in groups.schema)}, pivot int, dist double")
        numbered = _numbered(keyed, ["pivot", "dist", "label", "v"], "index")
        self.written = numbered
        self.rows = numbered.withColumn("cell", F.shiftright("number", CELL) * 1024 + F.col("pivot")).drop("number")
        self.cells = staged(self.rows.groupBy("pivot", "cell").agg(F.min("dist").alias("c_lo"), F.max("dist").alias("c_hi")), "cells")
        discard(groups)

    def search(self, probes: DataFrame, k: int) -> DataFrame:
        """probes: pid, own (a row that isn't an answer), label, same (or others), v, low, high (scores); to pid, score, id, row: each one's k best."""
        begun = probes.mapInPandas(_begin(self.space, k), f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in probes.schema)}, home int, at double, d array<double>, near double, target double, old double, r double, norm double, pad double")
        # Neighbouring probes share a block, so that a block asks for few cells.
        used = _numbered(begun, ["home", "at", "pid"], "probes")
        state = used.withColumn("block", F.shiftright("number", BLOCK)).drop("home", "at", "number")
        best = None
        while True:
            scanned = self._scan(state, k)
            both = scanned if best is None else best.union(scanned)
            turn = F.row_number().over(Window.partitionBy("pid").orderBy(F.desc("score"), "id", "row"))
            found = staged(both.withColumn("_turn", turn).where(F.col("_turn") <= k).drop("_turn"), "best")
            sums = found.groupBy("pid").agg(F.count("*").alias("_n"), F.min("score").alias("_least"))
            after = state.join(sums, "pid", "left")
            # Unscanned vectors are farther than r. Scores are whole numbers, so half of one tells those below the k-th from its equals.
            enough = F.sqrt(F.greatest(F.lit(0.0), F.col("norm") - 2.0 * F.col("_least") + 1.0) + F.col("norm") * SURE * 2 + 1e-9)
            full = F.coalesce(F.col("_n") >= k, F.lit(False))
            target = F.when(full, F.least("target", enough)).otherwise(F.col("target"))
            after = after.withColumn("target", target).where("r < target")
            wider = F.when(full, F.col("target")).otherwise(F.least(F.col("target"), F.greatest(2 * F.col("r"), F.col("target") / 64)))
            after = staged(after.withColumns({"old": F.col("r"), "r": wider}).drop("_n", "_least"), "probes")
            discard(used, *([] if best is None else [best]))
            used, state, best = after, after, found
            if not state.head(1):
                discard(used)
                return best

    def _scan(self, state: DataFrame, k: int) -> DataFrame:
        """What the probes' new intervals hold, at most k rows a probe and part."""
        spans = state.select("block", "near", "r", "old", "pad", F.posexplode("d").alias("pivot", "d"))
        lo, hi = F.greatest(F.col("d") - F.col("r"), F.col("near") - F.col("d")) - F.col("pad"), F.col("d") + F.col("r") + F.col("pad")
        spans = spans.groupBy("block", "pivot").agg(F.min(lo).alias("lo"), F.max(hi).alias("hi"))
        asked = self.cells.join(spans, (self.cells["pivot"] == spans["pivot"]) & (F.col("c_hi") >= F.col("lo")) & (F.col("c_lo") <= F.col("hi"))).select("cell", "block")
        part = F.shiftright("cell", PART + 10).alias("part")
        held = self.rows.join(asked, "cell").select(F.col("block").alias("h_block"), part.alias("h_part"), "pivot", "dist", "label", "v", "ids", "rows")
        probes = state.join(asked.select("block", part).distinct(), "block").select("block", "part", "pid", "own", F.col("label").alias("asked_label"), "same", F.col("v").alias("q"), "low", "high", "d", "near", "r", "old", "pad")
        return probes.groupBy("block", "part").cogroup(held.groupBy("h_block", "h_part")).applyInPandas(_scan(k), "pid long, score long, id long, row long")

    def discard(self) -> None:
        discard(self.written, self.cells)


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score: hard negatives of each row that is_anchor holds for.

    A score is the inner product of two rows' vectors floor(scale * x), whole numbers; higher ones come first, ties go to smaller ids. An
    anchor's positives are its first `positives` other rows of the same label, and for each of them the negatives are the first `negatives`
    rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score; all, where there are fewer.

    Rows without an id or a label, with a null or empty vector, or with a null or non-finite component take no part. Rows are told apart by
    themselves: a row that shares the anchor's id can be its positive, and each of several anchor rows of one id has its own answers. Only vectors of equal length are compared. Scores must
    stay within 55 bits. Other columns aren't read. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    x = F.col(vector_col).cast("array<double>")
    fine = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))), F.lit(False)) & (F.size(x) > 0)
    rows = vectors.where(F.col(id_col).isNotNull() & label.isNotNull() & fine).select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), is_anchor.alias("anchor"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("v"))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    out = spark.createDataFrame([], _RESULT)
    for (dim,) in rows.where("anchor").select(F.size("v")).distinct().orderBy(F.size("v")).collect():
        some = rows.where(F.size("v") == dim)
        index = Index(some, max(positives, negatives) + 1)
        anchors = some.where("anchor").select("row", "id", "label", "v")
        nothing = F.lit(_LOWEST).cast("long").alias("low"), F.lit(_HIGHEST).cast("long").alias("high")
        near = index.search(anchors.select(F.col("row").alias("pid"), F.col("row").alias("own"), "label", F.lit(True).alias("same"), "v", *nothing), positives)
        turn = F.row_number().over(Window.partitionBy("pid").orderBy(F.desc("score"), "id", "row"))
        pairs = near.select((F.col("pid") * positives + turn - 1).alias("pair"), F.col("pid").alias("row"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        pairs = staged(pairs.join(anchors, "row").select("pair", "row", F.col("id").alias("anchor_id"), "label", "v", "positive_id", "positive_score"), "pairs")
        share = lambda p: F.col("positive_score").cast("decimal(20,0)") * p / 100
        probes = pairs.select(F.col("pair").alias("pid"), F.col("row").alias("own"), "label", F.lit(False).alias("same"), "v", F.ceil(share(low)).cast("long").alias("low"), F.floor(share(high)).cast("long").alias("high"))
        found = index.search(probes.where("low <= high"), negatives)
        rank = F.row_number().over(Window.partitionBy("pid").orderBy(F.desc("score"), "id", "row")).alias("rank")
        found = found.select("pid", rank, F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        out = out.union(found.join(pairs, F.col("pid") == F.col("pair")).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
        index.discard()
        discard(near)
    return out
