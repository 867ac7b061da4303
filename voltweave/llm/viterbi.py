"""Token counts of a unigram tokenizer, without its tokens.

An Aho-Corasick automaton lists the vocabulary's matches in a word; dynamic programming over their ends carries the best score and
the number of pieces behind it. Ties are the tokenizer's: of equal scores the longest last piece stays, a character that
isn't a piece costs the lowest score less 10, and neighbouring ones count as one unknown piece. Words are counted once and
remembered, as counts of words add up: the tokenizer parts texts at white space.

With the file's own rules nothing of a text is dropped: blanks become MARK, one is put before the text, line breaks and other characters that
aren't pieces are spelt in bytes, a token each, and control and byte pieces match no text. No piece holds MARK after another character or
reaches over a line break, so texts are parted there, and counts of the parts add up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "\u2581"
UNKNOWN_COST = 10.0
REMEMBER = 700_000

#: White space as Unicode has it; Python's split() also parts at four control characters.
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: A run of marks and what follows it; line breaks apart. All of a text.
_PARTS = re.compile(f"\n+|{MARK}*[^{MARK}\n]+|{MARK}+")
_COUNTERS: dict[tuple[str, bool], UnigramCounter] = {}


def unigram_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


def text_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file that stand for text: no control, unknown, unused or byte pieces."""
    from sentencepiece import SentencePieceProcessor

    m = SentencePieceProcessor(model_file=path)
    return [(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i))]


class UnigramCounter:
    """Counts pieces under (piece, score) pairs; the first of equal pieces counts. in_bytes: the file's own rules, see above."""

    def __init__(self, vocabulary: list[tuple[str, float]], in_bytes: bool = False):
        import ahocorasick

        self.in_bytes = in_bytes
        if in_bytes and any(MARK in p.lstrip(MARK) or "\n" in p for p, _ in vocabulary):
            raise ValueError("a piece reaches over a place where texts are parted")
        self.automaton, self.lowest = ahocorasick.Automaton(), min(s for _, s in vocabulary)
        for piece, score in reversed(vocabulary):
            if piece:
                self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pieces, self.scores, self.unknown = np.zeros(1024, np.int64), np.zeros(1024), np.zeros(1024, np.int64)

    def best(self, word: str) -> tuple[int, float, int]:
        """Pieces, score and unknown pieces of the best parting of the marked word."""
        text = word if self.in_bytes else MARK + word
        n = len(text)
        score, count, unknown, open_end = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, piece in self.automaton.iter(text):
            matches[end].append(piece)
        penalty = self.lowest - UNKNOWN_COST
        for end in range(1, n + 1):
            top, at, single = None, 0, False
            for size, s in sorted(matches[end - 1], reverse=True):
                single = single or size == 1
                s += score[end - size]
                if top is None or s > top:
                    top, at = s, end - size
            lone = None if single else penalty + score[end - 1]
            if lone is not None and (top is None or lone > top):
                score[end], at, open_end[end] = lone, end - 1, True
                fresh = len(text[at].encode("utf-8", "replace")) if self.in_bytes else not open_end[at]
                count[end], unknown[end] = count[at] + fresh, unknown[at] + (1 if self.in_bytes else fresh)
            else:
                score[end], count[end], unknown[end] = top, count[at] + 1, unknown[at]
        return count[n], score[n], unknown[n]

    def count(self, text: str | None) -> tuple[int, int, float, int]:
        """Words, pieces, score and unknown pieces of a whole text."""
        text = text or ""
        words = text.split() if not any(c in text for c in "\x1c\x1d\x1e\x1f") else [w for w in _SPACE.split(text) if w]
        n_words, known = len(words), self.known
        if self.in_bytes:
            words = _PARTS.findall(MARK + text.replace(" ", MARK)) if text else []
        fresh = [w for w in dict.fromkeys(words) if w not in known]
        if len(known) + len(fresh) > REMEMBER and known:
            self.forget()
            return self.count(text)
        for w in fresh:
            i = known[w] = len(known)
            if i == len(self.pieces):
                self.pieces, self.scores, self.unknown = (np.concatenate([x, np.zeros_like(x)]) for x in (self.pieces, self.scores, self.unknown))
            self.pieces[i], self.scores[i], self.unknown[i] = self.best(w)
        at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        return n_words, int(self.pieces[at].sum()), float(self.scores[at].sum()), int(self.unknown[at].sum())


def counter_at(path: str, in_bytes: bool = False) -> UnigramCounter:
    if (path, in_bytes) not in _COUNTERS:
        _COUNTERS[path, in_bytes] = UnigramCounter(text_pieces(path) if in_bytes else unigram_vocabulary(path), in_bytes)
    return _COUNTERS[path, in_bytes]


def count_tokens(docs: DataFrame, model_path: str, in_bytes: bool = False) -> DataFrame:
    """doc_id, n_words, n_tokens, score, n_unknown for every row of docs (doc_id, text).

    model_path is a sentencepiece file whose pieces and scores are the vocabulary; in_bytes: white space, unknown characters and
    special pieces as the file has them, n_unknown being the characters spelt in bytes. Null or empty text has no tokens and score 0. Other
    columns aren't read; repeated rows are counted each. An empty table gives an empty result.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = counter_at(model_path, in_bytes)
        for b in batches:
            made = pd.DataFrame([counter.count(t) for t in b["text"]], columns=["n_words", "n_tokens", "score", "n_unknown"])
            yield pd.concat([b[["doc_id"]].reset_index(drop=True), made], axis=1)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_words long, n_tokens long, score double, n_unknown long")
