"""Language identification with a linear-chain conditional random field over words.

Every word that holds a letter is labelled with a language; features of the word (affixes, character n-grams, the word itself, and
whether a lexicon lists it) give its scores, learned transitions tie neighbours, and forward-backward gives each word's
marginal probabilities, so texts that switch languages get a label for each word. A document's language is the one
with the largest share of marginal probability.

Training takes a bounded sample: of each of the LANGUAGES most frequent languages the PER_LANGUAGE labelled training documents with
the smallest hash of id and text, and of each of these SEGMENTS runs of RUN words, which the executors cut. Runs of different documents
are strung together, so that transitions between languages occur. The model is a table of BUCKETS hashed features by languages,
whatever the corpus.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytewords import mix
from .common import crc_fold, small_batches

#: Bounds of the training sample; words of over LETTERS characters aren't learned from.
LANGUAGES, PER_LANGUAGE, SEGMENTS, RUN, LETTERS = 100, 300, 3, 18, 64
BUCKETS = 1 << 16
LEXICON = 2000
ROUNDS, RATE, DECAY = 40, 0.15, 1e-5
#: Words whose scores a worker remembers; documents and words that forward-backward takes at once.
REMEMBER, TOGETHER, CELLS = 250_000, 256, 250_000

UNKNOWN = "und"
PUNCTUATION = ".,;:!?\"'()[]{}|*#$%&-_=+<>/"


def tokens(text: str | None) -> list[str]:
    """The words of a text, by white space, in lower case."""
    return (text or "").lower().split()


def has_letter(word: str) -> bool:
    return word.isalpha() or any(c.isalpha() for c in word)


def core(word: str) -> str:
    """The word without punctuation at its ends."""
    return word.strip(PUNCTUATION) or word


def features(words: list[str], lexicon: dict[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the words, and whose each is: n-grams of 1 to 4 characters with the word's ends marked, prefixes and
    suffixes of 2 and 3 characters, the word itself, and its language in the lexicon."""
    cores = [core(w) for w in words]
    codes = np.frombuffer("".join([f"<{c}>" for c in cores]).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    length = np.array([len(c) + 2 for c in cores])
    end = np.cumsum(length)
    start, owner = end - length, np.repeat(np.arange(len(cores)), length)
    found, whose = [], []
    h = np.zeros(len(codes), np.uint64)
    for n in (1, 2, 3, 4):
        h = h[: len(codes) - n + 1] * np.uint64(1000003) + codes[n - 1 :]
        ok = np.flatnonzero(np.arange(len(h)) + n <= end[owner[: len(h)]])
        found.append(mix(h[ok] + np.uint64(n << 56)))
        whose.append(owner[ok])
        if n > 2:  # with the mark, so many and one less
            some = np.flatnonzero(length >= n)
            found += [mix(h[start[some]] + np.uint64(11 << 56)), mix(h[end[some] - n] + np.uint64(12 << 56))]
            whose += [some, some]
    everyone = np.arange(len(cores))
    found += [mix(np.array([zlib.crc32(c.encode("utf-8", "replace")) for c in cores], np.uint64) + np.uint64(13 << 56)), mix(np.array([zlib.crc32(lexicon.get(c, "").encode()) for c in cores], np.uint64) + np.uint64(14 << 56))]
    whose += [everyone, everyone]
    return (np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate(whose)


def _sums(weights: np.ndarray, found: np.ndarray, whose: np.ndarray, n: int) -> np.ndarray:
    """Of each word, its features' mean weights, times the root of their number."""
    many = np.sqrt(np.bincount(whose, minlength=n))
    return np.stack([np.bincount(whose, weights[found, y], n) / many for y in range(weights.shape[1])], 1)


class Scorer:
    """Scores of words under a model, remembered for the words seen so far."""

    def __init__(self, model: dict):
        self.model, self.width = model, len(model["languages"])
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.scores = np.zeros((1024, self.width), np.float32)
        self.used = 0

    def rows(self, words: list[str]) -> np.ndarray:
        """Where each word's scores are; -1 for words without a letter."""
        at = self.at
        fresh = [w for w in dict.fromkeys(words) if w not in at]
        if fresh:
            if self.used + len(fresh) > REMEMBER and self.used:
                self.forget()
                return self.rows(words)
            lettered = [w for w in fresh if has_letter(w)]
            at.update(dict.fromkeys(fresh, -1))
            for i in range(0, len(lettered), 20_000):
                part = lettered[i : i + 20_000]
                sums = _sums(self.model["weights"], *features(part, self.model["lexicon"]), len(part))
                while self.used + len(part) > len(self.scores):
                    self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
                self.scores[self.used : self.used + len(part)] = sums
                at.update(zip(part, range(self.used, self.used + len(part)), strict=True))
                self.used += len(part)
        return np.fromiter((at[w] for w in words), np.int64, len(words))


class Posteriors(NamedTuple):
    """Of chains of words: marginals (time, chain, label), what passes forward and backward, and the logarithm of each chain's sum over all labellings."""

    marginals: np.ndarray
    forward: np.ndarray
    backward: np.ndarray
    emitted: np.ndarray
    log_sum: np.ndarray


def posteriors(scores: np.ndarray, length: np.ndarray, start: np.ndarray, trans: np.ndarray) -> Posteriors:
    """Forward-backward over chains that are padded at their ends to the same time; scores (time, chain, label), start and trans are logarithms."""
    top = scores.max(2, keepdims=True)
    e = np.exp(scores - top)
    t, a = len(e), np.exp(trans - trans.max())
    alpha, beta, sums = np.empty_like(e), np.empty_like(e), np.empty(e.shape[:2], e.dtype)
    now = np.exp(start - start.max()) * e[0]
    for i in range(t):
        if i:
            now = now @ a * e[i]
        sums[i] = now.sum(1)
        now = now / sums[i][:, None]
        alpha[i] = now
    now = np.ones_like(e[0])
    for i in range(t - 1, -1, -1):
        beta[i] = now
        if i:
            now = (e[i] * now) @ a.T
            now /= now.sum(1, keepdims=True)
            now[length <= i] = 1.0  # beyond a chain's end nothing is known
    out = alpha * beta
    inside = np.arange(t)[:, None] < length
    log_sum = ((np.log(sums) + top[:, :, 0]) * inside).sum(0) + start.max() + (length - 1) * trans.max()
    return Posteriors(out / out.sum(2, keepdims=True), alpha, beta, e, log_sum)


def forward_backward(scores: np.ndarray, length: np.ndarray, start: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Marginals (time, chain, label) alone."""
    return posteriors(scores, length, start, trans).marginals


class Chains:
    """Labelled chains of words, as the training reads them."""

    def __init__(self, chains: list[list[tuple[list[str], int]]], lexicon: dict[str, str], labels: int):
        vocabulary: dict[str, int] = {}
        t, n = max(sum(len(w) for w, _ in c) for c in chains), len(chains)
        self.word, self.gold, self.length = np.zeros((t, n), np.int64), np.zeros((t, n), np.int64), np.zeros(n, np.int64)
        for j, c in enumerate(chains):
            for words, lang in c:
                for w in words:
                    self.word[self.length[j], j], self.gold[self.length[j], j] = vocabulary.setdefault(w, len(vocabulary)), lang
                    self.length[j] += 1
        self.words, self.labels = len(vocabulary), labels
        self.found, self.whose = features(list(vocabulary), lexicon)
        self.scale = 1 / np.sqrt(np.bincount(self.whose))
        self.inside = np.arange(t)[:, None] < self.length

    def objective(self, weights: np.ndarray, start: np.ndarray, trans: np.ndarray) -> tuple[float, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The labellings' log likelihood, and its gradients by weights, start and trans: what occurs less what is expected."""
        one, chain = np.eye(self.labels), np.arange(len(self.length))
        scores = _sums(weights, self.found, self.whose, self.words)[self.word]
        p = posteriors(scores, self.length, start, trans)
        taken = (np.take_along_axis(scores, self.gold[:, :, None], 2)[:, :, 0] * self.inside).sum() + start[self.gold[0]].sum()
        taken += (trans[self.gold[:-1], self.gold[1:]] * self.inside[1:]).sum()
        error = (one[self.gold] - p.marginals) * self.inside[:, :, None]
        by_word = np.stack([np.bincount(self.word.ravel(), error[:, :, y].ravel(), self.words) for y in range(self.labels)], 1) * self.scale[:, None]
        by_weight = np.stack([np.bincount(self.found, by_word[self.whose, y], len(weights)) for y in range(self.labels)], 1)
        # A pair's marginal: what comes forward to the first, the step, and the second with what comes back to it.
        pair = p.forward[:-1, :, :, None] * np.exp(trans - trans.max()) * (p.emitted[1:] * p.backward[1:])[:, :, None, :]
        pair /= pair.sum((2, 3), keepdims=True)
        occurs = one[self.gold[:-1]][:, :, :, None] * one[self.gold[1:]][:, :, None, :]
        by_step = ((occurs - pair) * self.inside[1:, :, None, None]).sum((0, 1))
        return float(taken - p.log_sum[chain].sum()), (by_weight, (one[self.gold[0]] - p.marginals[0]).sum(0), by_step)


def cut_runs(text: str, seed: int) -> list[list[str]]:
    """SEGMENTS runs of RUN words of the text, drawn by the seed; all its words as one run where it has fewer."""
    words = [w for w in tokens(text) if len(w) <= LETTERS and has_letter(w)]
    pieces = [words[i : i + RUN] for i in range(0, len(words), RUN)]
    drawn = [pieces[i] for i in np.random.default_rng(seed).permutation(len(pieces))[:SEGMENTS]]
    return [p for p in drawn if len(p) == RUN or len(pieces) == 1]


def train(sample: list[tuple[list[list[str]], str]], seed: int = 7) -> dict | None:
    """The model from (runs of words, language) pairs; None if there is nothing to learn from."""
    languages = sorted({lang for _, lang in sample})
    runs = [(words, languages.index(lang)) for cut, lang in sample for words in cut]
    if not runs:
        return None
    by_word: dict[str, Counter] = {}
    for words, lang in runs:
        for w in set(words):
            by_word.setdefault(core(w), Counter())[lang] += 1
    sure = [(sum(c.values()), w, c.most_common(1)[0][0]) for w, c in by_word.items() if sum(c.values()) >= 5 and c.most_common(1)[0][1] >= 0.95 * sum(c.values())]
    lexicon = {w: languages[lang] for _, w, lang in sorted(sure, key=lambda x: (-x[0], x[1]))[:LEXICON]}
    order = np.random.default_rng(seed).permutation(len(runs))
    k, data = len(languages), Chains([[runs[i] for i in order[at : at + 3]] for at in range(0, len(order), 3)], lexicon, len(languages))
    weights, start, trans = np.zeros((BUCKETS, k)), np.zeros(k), np.zeros((k, k))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, start, trans)]
    for step in range(1, ROUNDS + 1):
        _, grads = data.objective(weights, start, trans)
        for x, g, (m, v) in zip((weights, start, trans), grads, moments, strict=True):
            g = g / data.inside.sum() - DECAY * x
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return {"languages": languages, "weights": weights.astype(np.float32), "start": start, "trans": trans, "lexicon": lexicon}


class Labelled(NamedTuple):
    """Of a text: its language and that one's share of marginal probability, words labelled, and the runs of words of one language, as language:start:end."""

    lang: str = UNKNOWN
    share: float = 0.0
    words: int = 0
    runs: str = ""


def label_texts(scorer: Scorer, texts: list[str | None]) -> list[Labelled]:
    model = scorer.model
    out = [Labelled()] * len(texts)
    chains, cells = [], 0
    for i, text in enumerate(texts):
        rows = scorer.rows(tokens(text))
        rows = rows[rows >= 0]
        if len(rows):
            chains.append((len(rows), i, scorer.scores[rows]))
            cells += len(rows)
        if cells >= 4 * CELLS:
            _label(chains, model, out)
            chains, cells = [], 0
    _label(chains, model, out)
    return out


def _label(chains: list, model: dict, out: list) -> None:
    chains = sorted(chains, key=lambda c: c[:2])
    while chains:
        take = max(1, min(TOGETHER, CELLS // chains[-1][0]))
        part, chains = chains[-take:], chains[:-take]
        length = np.array([c[0] for c in part])
        scores = np.zeros((length.max(), len(part), len(model["languages"])), np.float32)
        for j, c in enumerate(part):
            scores[: c[0], j] = c[2]
        p = forward_backward(scores, length, model["start"].astype(np.float32), model["trans"].astype(np.float32))
        inside = np.arange(len(p))[:, None] < length
        share = (p * inside[:, :, None]).sum(0) / length[:, None]
        best, top = p.argmax(2), share.argmax(1)
        changes = (best[1:] != best[:-1]) & inside[1:]
        for j, c in enumerate(part):
            edges = [0, *(np.flatnonzero(changes[:, j]) + 1).tolist(), c[0]]
            runs = ",".join(f"{model['languages'][best[a, j]]}:{a}:{b}" for a, b in zip(edges, edges[1:], strict=False))
            out[c[1]] = Labelled(model["languages"][top[j]], min(1.0, float(share[j, top[j]])), c[0], runs)


def _sample(docs: DataFrame, folds: int, held_fold: int) -> DataFrame:
    """lang, turn, runs: the training sample, cut on the executors."""
    labelled = docs.select("doc_id", "lang", F.col("text").cast("string").alias("text")).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_fold(F.col("doc_id"), folds) != held_fold))
    # A hash below 2 * PER_LANGUAGE / (the language's rows) keeps about twice as many as are wanted, so the ranking sees few rows whatever the corpus.
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    limits = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], int(min(1.0, 2 * PER_LANGUAGE / r["count"]) * 2**31))]) if counts else F.create_map().cast("map<string,int>")
    few = labelled.withColumn("h", F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**31))).where(F.col("h") <= limits[F.col("lang")])
    by_hash = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    some = few.withColumn("turn", F.row_number().over(by_hash)).where(F.col("turn") <= PER_LANGUAGE)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"lang": b["lang"], "turn": b["turn"], "runs": [cut_runs(t, int(h)) for t, h in zip(b["text"], b["h"], strict=True)]})

    return some.mapInPandas(cut, "lang string, turn int, runs array<array<string>>")


def fit(docs: DataFrame, folds: int = 5, held_fold: int = 0) -> dict | None:
    """Trains on labelled rows outside the held-out fold; what the driver gets is bounded by LANGUAGES, PER_LANGUAGE, SEGMENTS, RUN and LETTERS."""
    rows = _sample(docs, folds, held_fold).collect()
    return train([(r["runs"], r["lang"]) for r in sorted(rows, key=lambda r: (r["lang"], r["turn"]))])


def identify(docs: DataFrame, folds: int = 5, held_fold: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_words, n_switches, runs for every row of docs (doc_id, text, lang).

    The model learns from text and lang of rows whose crc32(doc_id as text) modulo folds isn't held_fold; predictions read the text
    only. runs lists the stretches of words (counted from 0 over words with a letter, end exclusive) labelled with one language, n_switches the
    changes between them. Null text, or text without a letter, is 'und' with score 0 and no runs, and so is everything where nothing is labelled. Equal
    shares go to the first language by code point. Repeated rows are labelled alike, a null doc_id stays null. Other columns aren't
    read. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    model = fit(docs, folds, held_fold)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model) if model else None
        for b in batches:
            found = label_texts(scorer, b["text"].tolist()) if scorer else [Labelled()] * len(b)
            made = pd.DataFrame(found, columns=["lang_pred", "score", "n_words", "runs"])
            made.insert(3, "n_switches", [x.runs.count(",") for x in found])
            yield pd.concat([b[["doc_id", "held_out"]].reset_index(drop=True), made], axis=1)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_fold(F.col("doc_id"), folds) == held_fold).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(predict, "doc_id long, held_out boolean, lang_pred string, score double, n_words long, n_switches long, runs string")


def keep_identified(docs: DataFrame, least: float = 1 / 3, folds: int = 5, held_fold: int = 0) -> DataFrame:
    """The rows of docs whose language is known: not 'und', and with a share of at least `least`. A null lang gets the prediction; columns as given.

    Null, empty and letterless texts go; of repeated rows all stay or all go; a null doc_id doesn't matter. An empty table, or one
    where nothing is labelled, gives no rows.
    """
    small_batches(docs.sparkSession)
    model = fit(docs, folds, held_fold)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for b in batches:
            found = label_texts(scorer, b.column("text").to_pylist()) if scorer else [Labelled()] * b.num_rows
            lang = [given if given is not None else f.lang for given, f in zip(b.column("lang").to_pylist(), found, strict=True)]
            b = b.set_column(b.schema.get_field_index("lang"), b.schema.field("lang"), pa.array(lang, pa.string()))
            yield b.filter(pa.array([f.lang != UNKNOWN and f.share >= least for f in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
