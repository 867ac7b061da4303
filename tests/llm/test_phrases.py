"""Collocations: brute force in exact arithmetic, the perfect hash, candidates in turns, odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltweave.llm import phrases
from voltweave.llm.phrases import PerfectHash, bitmap, collocations


def brute(rows, least, longest=5, top=2000, covered=100):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang, text = lang if lang is not None else "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    often = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inner = Counter()
    for (lang, *w), a in often.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                inner[lang, *w[i : i + m]] = max(inner[lang, *w[i : i + m]], a)
    found = {}
    for (lang, *w), a in often.items():
        if 100 * inner[lang, *w] >= covered * a and inner[lang, *w]:
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w)))
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, rows_ in found.items() for r, (s, a, p, left, right) in enumerate(sorted(rows_)[:top], 1))


def frame(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    for c in ("key", "n", "first", "last", "data", "level", "f", "words", "l", "r", "rank", "doc_id"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def made(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["Über", "日本", "x'y", "Ab", "aB"]
    fixed = ["once upon a time", "once upon a hill", "the the the the the the", "New York City"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(12)):
            parts.append(rng.choice(fixed) if rng.random() < 0.5 else " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(6))))
            parts.append(rng.choice([" ", ". ", ",", "\n", "\t", "!?", "\x0b", "  "]))
        rows.append((rng.choice(["en", "en", "de", None]), "".join(parts)))
    return rows


@pytest.mark.parametrize("least, split, slots", [(4, 1 << 20, 1 << 21), (4, 40, 10), (12, 100, 50)])
def test_equal_to_brute_force(spark, monkeypatch, least, split, slots):
    monkeypatch.setattr(phrases, "SPLIT", split)
    monkeypatch.setattr(phrases, "SLOTS", slots)
    monkeypatch.setattr(phrases, "BLOCK", 16)
    monkeypatch.setattr(phrases, "SLICE", 7)
    rows = made(least)
    assert sorted(tuple(r) for r in collocations(frame(spark, rows), least).collect()) == brute(rows, least)


def test_reports_come_in_turns_and_rows_are_written_once(spark, monkeypatch):
    written, staged = [], phrases.staged

    def spy(df, name, **kw):
        out = staged(df, name, **kw)
        written.append((name, sorted(r[0] for r in out.select("key").collect()) if name.startswith("level") else None))
        return out

    rows = made(7)
    whole = [r[:] for r in brute(rows, 4)]
    monkeypatch.setattr(phrases, "staged", spy)
    assert sorted(map(tuple, collocations(frame(spark, rows), 4).collect())) == whole
    names = [name for name, _ in written]
    assert "words" not in names and names.count("thin") == 1
    level2 = [keys for name, keys in written if name == "level2"]
    assert len(level2) == phrases.TURNS and all(level2)
    assert len({k for keys in level2 for k in keys}) == sum(map(len, level2))


def test_texts_pass_one_python_worker_a_task(spark, monkeypatch):
    """Each worker adds to an executor's memory; rows of a second one would also pass through the JVM."""
    workers, staged = [], phrases.staged

    def spy(df, name, **kw):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        workers.append((name, plan.count("MapInPandas")))
        return staged(df, name, **kw)

    monkeypatch.setattr(phrases, "staged", spy)
    phrases.candidates(frame(spark, made(3, 20)).select(F.coalesce("lang", F.lit("und")).alias("lang"), "text"), 3, 2)
    assert [x for x in workers if x[0] in ("level1", "thin")] == [("level1", 1), ("thin", 1)]


def test_limits_and_cover(spark):
    rows = made(9)
    assert sorted(tuple(r) for r in collocations(frame(spark, rows), 3, longest=3, top=7, covered=80).collect()) == brute(rows, 3, 3, 7, 80)


def test_odd_rows(spark):
    rows = [("en", None), (None, None), (None, ""), ("en", " \t .,;:"), ("en", "a b " * 5000), ("fr", "a b"), (None, "a b. a b! a b")] + [("en", "same words")] * 5
    assert sorted(tuple(r) for r in collocations(frame(spark, rows), 3).collect()) == brute(rows, 3)
    empty = collocations(frame(spark, rows).limit(0), 3)
    assert empty.count() == 0 and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert collocations(frame(spark, [("en", "once only")]), 3).count() == 0


def test_perfect_hash_is_minimal_and_knows_strangers():
    keys = np.random.default_rng(1).integers(1, 2**63, 5000, dtype=np.uint64)
    made = PerfectHash(keys)
    assert sorted(made.slots(keys).tolist()) == list(range(len(keys))) and (made.keys[made.slots(keys)] == keys).all()
    assert (made.slots(keys + np.uint64(1)) == -1).sum() >= 4999 and not len(PerfectHash(keys[:0]).keys) and (PerfectHash(keys[:0]).slots(keys) == -1).all()


def test_bitmap_has_its_keys(spark):
    keys = np.random.default_rng(2).integers(-(2**62), 2**62, 3000)
    bits = bitmap(spark.createDataFrame([(int(k),) for k in keys], "key long"), len(keys))
    assert bits.has(keys.view(np.uint64)).all() and bits.has((keys + 1).view(np.uint64)).mean() < 0.2
