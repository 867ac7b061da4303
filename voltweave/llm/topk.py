"""Exact top-k search by distributed histogram selection.

Queries and candidates are dealt out in blocks; a task scores one block of candidates against one block of queries. Each round
counts, for every query, how many scores fall in each of BINS equal parts of the range that is known to hold its k-th
score; the sums over all tasks shrink that range to one part. When the ranges are one score wide the k-th score is known
exactly, and a last pass keeps what is above it and, of the ties at it, the smallest ids. Of a histogram a task reports only
the bins down to its own k-th score (the global one can't be lower), and of the ties its k smallest ids, so what is shuffled
is at most k rows a query and task, whatever the scores look like.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, staged

BINS = 4096
CANDIDATES, QUERIES = 4096, 1024
#: Scores held at once: queries of a slice times candidates.
SLICE = 64


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int, is_query: Column) -> DataFrame:
    """(id, v, asked) with v = floor(scale * component) as array<long>; rows with a null id, a null or non-finite component or none are left out."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(fine, F.lit(False)) & (F.size(x) > 0)).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asked"))


def _scores(queries: pd.DataFrame, candidates: pd.DataFrame):
    """Slices of queries with their scores against the block's candidates; a query's own row is left to the caller.

    Integer products are done in float64 as long as no sum can pass 2^53, which makes them exact, else in int64.
    """
    c = np.stack(candidates["c_v"].to_list()).astype(np.int64)
    high = int(np.abs(c).max(initial=0))
    for i in range(0, len(queries), SLICE):
        part = queries.iloc[i : i + SLICE]
        q = np.stack(part["q_v"].to_list()).astype(np.int64)
        if high * int(np.abs(q).max(initial=0)) * c.shape[1] < 2**53:
            yield part, (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
        else:
            yield part, q @ c.T


def _histogram(k: int):
    def run(key, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(candidates):
            rows = candidates["c_row"].to_numpy()
            for part, scores in _scores(queries, candidates):
                for query, low, width, s in zip(part["q_row"], part["low"], part["width"], scores, strict=True):
                    s = s[(rows != query) & (s >= low)]
                    at = np.minimum((s - low) // width, BINS)  # above the range: one more bin
                    if len(at) > k:
                        at = at[at >= np.partition(at, len(at) - k)[len(at) - k]]
                    found += [(query, int(b), int(n)) for b, n in zip(*np.unique(at, return_counts=True), strict=True)]
        return pd.DataFrame(found, columns=["row", "bin", "n"]).astype("int64")

    return run


def _select(k: int):
    def run(key, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(candidates):
            ids, rows = candidates["c_id"].to_numpy(), candidates["c_row"].to_numpy()
            for part, scores in _scores(queries, candidates):
                for query, low, s in zip(part["q_row"], part["low"], scores, strict=True):
                    at = np.flatnonzero((rows != query) & (s >= low))
                    at = at[np.lexsort((rows[at], ids[at], -s[at]))[:k]]
                    found += [(query, int(ids[j]), int(rows[j]), int(s[j])) for j in at]
        return pd.DataFrame(found, columns=["query", "id", "other", "score"]).astype("int64")

    return run


def _paired(queries: DataFrame, candidates: DataFrame, state: DataFrame, blocks: tuple[int, int], run, schema: str) -> DataFrame:
    """Runs on every block of candidates with every block of queries of the same dim; blocks: how many there are of queries, candidates."""
    others, asked_for = F.explode(F.expr(f"sequence(0, {blocks[1] - 1})")), F.explode(F.expr(f"sequence(0, {blocks[0] - 1})"))
    q = queries.join(state, "row").select("dim", "block", others.alias("other"), "row", "v", "low", "width").toDF("q_dim", "q_block", "q_other", "q_row", "q_v", "low", "width")
    c = candidates.select("dim", asked_for.alias("other"), "block", "row", "id", "v").toDF("c_dim", "c_other", "c_block", "c_row", "c_id", "c_v")
    return q.groupBy("q_dim", "q_block", "q_other").cogroup(c.groupBy("c_dim", "c_other", "c_block")).applyInPandas(run, schema)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), id, score: for each row that is_query holds for, its k highest integer inner products with other rows.

    Ties go to the smaller id; all of them if fewer than k. Vectors that are null, empty, or hold null or non-finite components take
    no part; neither do null ids. Only vectors of equal length are compared. Rows are told apart by themselves, so a row meets others of its
    id, and each of several query rows of one id has its own k. Scores must stay within
    62 bits. Other columns aren't read. An empty table gives an empty result.
    """
    rows = staged(whole_vectors(vectors, id_col, vector_col, scale, is_query).withColumn("row", F.monotonically_increasing_id()), "rows")
    asked = rows.where("asked")
    blocks = max(1, -(-asked.count() // QUERIES)), max(1, -(-rows.count() // CANDIDATES))
    # By row, so that repeated rows are dealt over all blocks.
    queries, candidates = (df.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias("block"), "row", "id", "v") for df, n in zip((asked, rows), blocks, strict=True))

    # No score is outside +-(largest absolute components' product * dim).
    bound = candidates.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("m"), F.max("dim").alias("d")).first()
    most = min((bound["m"] or 0) ** 2 * (bound["d"] or 1) + 1, 2**62 - 1)
    width = -(-2 * most // BINS) or 1
    state = queries.select("row", F.lit(-most).cast("long").alias("low"), F.lit(width).cast("long").alias("width"))
    by_height = Window.partitionBy("row").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    while True:
        counts = _paired(queries, candidates, state, blocks, _histogram(k), "row long, bin long, n long").groupBy("row", "bin").agg(F.sum("n").alias("n"))
        # The k-th score's bin: the highest one down to which there are k. With fewer than k scores all are wanted.
        reached = counts.withColumn("down", F.sum("n").over(by_height)).groupBy("row").agg(F.max(F.when(F.col("down") >= k, F.col("bin"))).alias("bin"))
        before, state = state, state.join(reached, "row").select("row", (F.col("low") + F.coalesce("bin", F.lit(0)) * F.col("width")).alias("low"), F.lit(max(1, -(-width // BINS))).cast("long").alias("width"))
        state = staged(state, "state")
        if hasattr(before, "staged_path"):
            discard(before)
        if width == 1:
            break
        width = max(1, -(-width // BINS))
    found = _paired(queries, candidates, state, blocks, _select(k), "query long, id long, other long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id", "other"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return found.join(asked.select(F.col("row").alias("query"), F.col("id").alias("query_id")), "query").select("query_id", "rank", "id", "score")
