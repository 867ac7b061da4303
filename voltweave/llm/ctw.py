"""Scoring texts with a byte model by context-tree weighting.

A text is its UTF-8 bytes with A-Z in lower case and an end symbol (255, which UTF-8 doesn't use). Each byte is eight binary
decisions, and each decision in a context of up to DEPTH bytes has counts of ones and zeros. At every node the
Krichevsky-Trofimov estimate of its own counts is weighted against its subtree: Pw = (Pe + product of the children's Pw) / 2, from
the deepest contexts up. Read downwards, Pe / (2 Pw) is the weight of stopping at a node, and gives the mixture of the
estimates of all depths; a context that wasn't seen ends the path. The training texts fix the counts; scoring doesn't change them.

Everything is relational: counts of (DEPTH + 1)-grams over the whole training part, one aggregation a depth up, one join a
depth down. Texts are dealt out in buckets of about BUCKET bytes, which ask for the grams and words they hold; the answers
come back to the bucket by a join, so neither the model nor the vocabulary has to fit anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import SPACE, Lookup, lower_bytes, mix, words
from .common import crc_fold, discard, staged

DEPTH = 4
BUCKET = 24_000_000
#: Bytes of text that NumPy works on at once.
CHUNK = 2_000_000
END = 255

_MASK = np.uint64((1 << 8 * (DEPTH + 1)) - 1)
_PARTS = SPACE.copy()
_PARTS[END] = True
_END_WORD = int(mix(np.array([END], np.uint64))[0])
_LN2 = float(np.log(2.0))
_LOG10_2 = float(np.log10(2))


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of the texts: first, last, their bytes with DEPTH end symbols before, between and after, and where each text starts."""
    raws, first, size = [], 0, 0
    for i, t in enumerate(texts):
        raws.append(lower_bytes(t))
        size += len(raws[-1]) + DEPTH
        if size >= CHUNK or i == len(texts) - 1:
            pad = bytes([END]) * DEPTH
            data = np.frombuffer(pad + pad.join(raws) + pad, np.uint8)
            starts = DEPTH + np.concatenate(([0], np.cumsum([len(r) + DEPTH for r in raws])))
            yield first, i + 1, data, starts
            raws, first, size = [], i + 1, 0


def _grams(data: np.ndarray) -> np.ndarray:
    """For each byte from DEPTH on: it and the DEPTH bytes before it, in one number, the byte lowest."""
    n = len(data) - DEPTH
    out = np.zeros(n, np.uint64)
    for i in range(DEPTH + 1):
        out = (out << np.uint64(8)) | data[i : i + n]
    return out


def _predicted(starts: np.ndarray, n: int) -> np.ndarray:
    """Which of the n positions from DEPTH on are bytes of a text or its end symbol, not padding."""
    ok = np.ones(n, bool)
    for i in range(1, DEPTH):
        ok[starts[1:] - 2 * DEPTH + i] = False
    return ok


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(bucket, kind, key, n): distinct grams (kind 0) and word hashes (kind 1) of the texts; n: in training texts."""
    for batch in batches:
        for (bucket, train), b in batch.groupby(["bucket", "train"]):
            for first, last, data, starts in _chunks(b["text"].tolist()):
                grams = _grams(data)
                grams = grams[_predicted(starts, len(grams))]
                for kind, keys in ((0, grams), (1, np.append(words(data, _PARTS)[2], np.full(last - first, _END_WORD, np.uint64)))):
                    u, n = np.unique(keys, return_counts=True)
                    yield pd.DataFrame({"bucket": np.full(len(u), bucket, np.int32), "kind": np.full(len(u), kind, np.int8), "key": u.view(np.int64), "n": n if train else np.zeros(len(u), np.int64)})


def _score(bucket, docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    rows = []
    if len(docs):
        gram, word = (Lookup(a["key"].to_numpy(np.int64).view(np.uint64), a["value"].to_numpy(float)) for a in (answers[answers["kind"] == k] for k in (0, 1)))
        known_end = word.get(np.array([_END_WORD], np.uint64))[0]
        ids, held = docs["doc_id"].tolist(), docs["held_out"].tolist()
        for first, last, data, starts in _chunks(docs["text"].tolist()):
            grams = _grams(data)
            bits = gram.get(grams)
            predicted = _predicted(starts, len(grams))
            bits[~predicted] = 0
            score = np.add.reduceat(bits, starts[:-1] - DEPTH)
            per_byte = -score / _LOG10_2 / np.add.reduceat(predicted.astype(np.int64), starts[:-1] - DEPTH)
            at, _, keys = words(data, _PARTS)
            counts = word.get(keys)
            owner = np.searchsorted(starts, at, "right") - 1
            n = last - first
            n_words, n_known = np.bincount(owner, minlength=n), np.bincount(owner, counts > 0, minlength=n)
            base = np.bincount(owner, np.log10(counts + 1), minlength=n) + np.log10(known_end + 1)
            for j in range(n):
                rows.append((ids[first + j], held[first + j], int(n_words[j]) + 1, int(n_known[j]) + int(known_end > 0), float(base[j]), float(score[j]), float(per_byte[j])))
    return pd.DataFrame(rows, columns=["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "bits_per_byte"]).astype({"doc_id": "Int64"})


def _ln_gamma(x: Column) -> Column:
    """Stirling's series above 6, by the recurrence from below."""
    z = x + 6
    low = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    return (z - 0.5) * F.log(z) - z + 0.5 * float(np.log(2 * np.pi)) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5.0))) - F.log(low)


def _ln_kt(ones: Column, zeros: Column) -> Column:
    """Logarithm of the Krichevsky-Trofimov estimate of a sequence with so many ones and zeros."""
    a, b = ones.cast("double"), zeros.cast("double")
    return _ln_gamma(a + 0.5) + _ln_gamma(b + 0.5) - 2 * _ln_gamma(F.lit(0.5)) - _ln_gamma(a + b + 1.0)


def _decisions(grams: DataFrame) -> DataFrame:
    """Each gram's eight decisions: node (the byte's bits so far behind a leading one), bit; ctx is the gram without its byte."""
    byte = (F.col("key").bitwiseAND(255)).cast("int")
    g = grams.withColumn("byte", byte).withColumn("ctx", F.shiftright("key", 8)).withColumn("j", F.explode(F.array(*[F.lit(j) for j in range(8)])))
    node = F.expr("cast(shiftleft(1, j) | shiftright(byte, 8 - j) as int)")
    return g.withColumn("node", node).withColumn("bit", F.expr("shiftright(byte, 7 - j) & 1")).drop("byte", "j")


def tree(grams: DataFrame) -> DataFrame:
    """(key, n) of the training grams to (depth, ctx, node, p): the mixture's probability of a one where ctx is the deepest seen."""
    nodes = _decisions(grams).groupBy("ctx", "node").agg(F.sum(F.col("n") * F.col("bit")).alias("ones"), F.sum("n").alias("n"))
    levels = {}
    for depth in range(DEPTH, -1, -1):
        if depth < DEPTH:
            below = levels[depth + 1]
            short = F.col("ctx").bitwiseAND((1 << 8 * depth) - 1)
            nodes = below.groupBy(short.alias("ctx"), "node").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n"), F.sum("ln_pw").alias("ln_children"))
        nodes = nodes.withColumn("ln_pe", _ln_kt(F.col("ones"), F.col("n") - F.col("ones")))
        if depth < DEPTH:
            high, low = F.greatest("ln_pe", "ln_children"), F.least("ln_pe", "ln_children")
            nodes = nodes.withColumn("ln_pw", high + F.log1p(F.exp(low - high)) - _LN2)
            nodes = nodes.withColumn("stop", F.exp(F.col("ln_pe") - F.col("ln_pw") - _LN2))
        else:
            nodes = nodes.withColumn("ln_pw", F.col("ln_pe")).withColumn("stop", F.lit(1.0))
        kt = (F.col("ones") + 0.5) / (F.col("n") + 1.0)
        levels[depth] = staged(nodes.select("ctx", "node", "ones", "n", "ln_pw", "stop", kt.alias("kt")), f"depth{depth}")
    above, out = None, None
    for depth in range(DEPTH + 1):
        now = levels[depth].select("ctx", "node", "stop", "kt")
        if above is None:
            now = now.withColumns({"sum": F.lit(0.0), "rest": F.lit(1.0)})
        else:
            now = now.withColumn("up", F.col("ctx").bitwiseAND((1 << 8 * (depth - 1)) - 1)).join(above, ["up", "node"])
        goes_on = now.select(F.col("ctx").alias("up"), "node", (F.col("sum") + F.col("rest") * F.col("stop") * F.col("kt")).alias("sum"), (F.col("rest") * (1 - F.col("stop"))).alias("rest"))
        done = now.select(F.lit(depth).alias("depth"), "ctx", "node", (F.col("sum") + F.col("rest") * F.col("kt")).alias("p"))
        out = done if out is None else out.union(done)
        above = goes_on
    out = staged(out, "tree")
    discard(*levels.values())
    return out


def _log_p() -> Column:
    return F.log10(F.when(F.col("bit") == 1, F.col("p")).otherwise(1 - F.col("p")))


def gram_scores(grams: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, n) of all grams that are asked for to (key, value): log10 of the last byte's probability after the others."""
    seen = _decisions(grams.where("n > 0")).join(nodes.where(F.col("depth") == DEPTH), ["ctx", "node"]).groupBy("key").agg(F.sum(_log_p()).alias("value"))
    new = _decisions(grams.where("n = 0").select("key"))
    paths = new.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in range(DEPTH + 1)])))
    paths = paths.withColumn("ctx", F.expr("ctx & (shiftleft(1L, 8 * depth) - 1)"))
    deepest = paths.join(nodes, ["depth", "ctx", "node"], "left").groupBy("key", "node", "bit").agg(F.coalesce(F.max_by("p", F.when(F.col("p").isNotNull(), F.col("depth"))), F.lit(0.5)).alias("p"))
    return seen.union(deepest.groupBy("key").agg(F.sum(_log_p()).alias("value")))


def score_texts(docs: DataFrame, folds: int = 7, held_fold: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every row of docs (doc_id, text).

    Rows whose crc32(doc_id as text) modulo folds is held_fold are held out; the others train. score is the model's log10 probability
    of the text and its end, bits_per_byte that code's length over the text's bytes and its end; base_score that of its words under add-one smoothed word frequencies. Null text is empty: one
    end symbol. With nothing to learn from, every bit costs one bit. Repeated rows count as often as they occur; null ids are in the
    fold of the empty text. Other columns aren't read. An empty table gives an empty result.
    """
    held = crc_fold(F.col("doc_id"), folds) == held_fold
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text) + 1)).first()[0] or 0
    buckets = max(1, -(-int(size) // BUCKET))
    rows = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int").alias("bucket"), F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), text.alias("text"))

    counting = rows.repartition(buckets, "bucket").select("bucket", (~F.col("held_out")).alias("train"), "text")
    asked = staged(counting.mapInPandas(_count, "bucket int, kind byte, key long, n long").groupBy("bucket", "kind", "key").agg(F.sum("n").alias("n")), "asked")
    totals = staged(asked.groupBy("kind", "key").agg(F.sum("n").alias("n")), "totals")
    train_tokens, vocabulary = totals.where("kind = 1 and n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()

    grams = totals.where("kind = 0").select("key", "n")
    values = gram_scores(grams, tree(grams.where("n > 0"))).select(F.lit(0).cast("byte").alias("kind"), "key", "value")
    values = values.union(totals.where("kind = 1").select("kind", "key", F.col("n").cast("double")))
    answers = asked.select("bucket", "kind", "key").join(values, ["kind", "key"]).toDF("kind", "key", "asked_by", "value")
    # As many partitions as buckets on both sides, so that a task has about one bucket whatever the input.
    rows, answers = rows.repartition(buckets, "bucket"), answers.repartition(buckets, "asked_by")
    scored = rows.groupBy("bucket").cogroup(answers.groupBy("asked_by")).applyInPandas(_score, "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, bits_per_byte double")
    smoothing = float(np.log10(train_tokens + vocabulary + 1))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * F.lit(smoothing)).alias("base_score"), "score", "bits_per_byte")
