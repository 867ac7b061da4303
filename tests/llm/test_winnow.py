"""Winnowing: brute force, the match guarantee, neighbours across ranges, odd rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from voltweave.llm import winnow
from voltweave.llm.winnow import GRAM, WINDOW


def brute(text, gram, window):
    """(hash, place) of each window's smallest gram hash, the rightmost of equal ones."""
    if not text:
        return []
    gram = min(gram, len(text))
    h = [int(winnow.gram_hashes(winnow.code_points(text[i : i + gram]), gram)[0]) for i in range(len(text) - gram + 1)]
    window, out = min(window, len(h)), []
    for i in range(len(h) - window + 1):
        at = min(range(i, i + window), key=lambda j: (h[j] >> 24, -j))
        if not out or out[-1][1] != at:
            out.append((h[at], at))
    return out


@pytest.mark.parametrize("gram, window", [(32, 64), (5, 4), (7, 10), (1, 1)])
def test_fingerprints_equal_brute_force(gram, window):
    rng = random.Random(gram)
    for n in (0, 1, 4, 5, 31, 32, 33, 95, 96, 300):
        text = "".join(rng.choice("ab c\U0001f600é") for _ in range(n))
        for chunk in (1 << 20, 16):
            hashes, places = winnow.fingerprint(text, gram, window, chunk)
            assert list(zip(hashes.tolist(), places.tolist(), strict=True)) == brute(text, gram, window)


def test_shared_passages_share_a_hash_at_matching_places():
    rng = random.Random(3)
    draw = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    for _ in range(50):
        passage = draw(GRAM + WINDOW - 1)
        left, right = draw(rng.randrange(400)), draw(rng.randrange(400))
        a, b = ({(h, p - len(x)) for h, p in zip(*(v.tolist() for v in winnow.fingerprint(x + passage + draw(200))), strict=True)} for x in (left, right))
        assert a & b


def expected(rows):
    """Rows in order with the next one's text, as the report has them."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        share = len(text) // 4
        edited = text[: len(text) - share] + after[:share]
        prints = [winnow.fingerprint(t) for t in (text, edited, after)]
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        sets = [set(h.tolist()) for h, _ in prints]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), winnow.digest(*prints[0]), winnow.digest(*prints[1]), like(sets[0], sets[1]), like(sets[0], sets[2])))
    return out


def as_tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_report_takes_the_next_document_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(winnow, "RANGE", 2000)
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "ünder", "日本", "delta"]
    rows = [(i * 7 % 1000 - 300, " ".join(rng.choice(words) for _ in range(rng.choice((0, 1, 30, 200))))) for i in range(150)]
    rows += [(2000, "copy of a text " * 20), (2001, "copy of a text " * 20), (2**60 + 1, None), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for c in ("part", "h", "copy", "p", "no_id", "n_chars", "d", "first"):
        df = df.withColumn(c, F.lit("clash"))
    found = winnow.edit_report(df)
    assert as_tuples(found) == sorted(expected(rows), key=repr)
    assert winnow.edit_report(df.limit(0)).count() == 0 and found.columns == winnow.edit_report(df.limit(0)).columns


def test_repeated_rows_and_a_single_one(spark):
    one = winnow.edit_report(spark.createDataFrame([(5, "alone " * 50)], "doc_id long, text string")).collect()
    assert [r["near_next"] for r in one] == [1.0] and one[0]["n_chars"] == 300
    many = winnow.edit_report(spark.createDataFrame([(1, "same " * 60)] * 40 + [(1, None)] + [(None, None)] * 2, "doc_id long, text string")).collect()
    assert len(many) == 43 and len({r["fingerprint"] for r in many if r["n_chars"]}) == 1


def test_fingerprints_of_odd_rows(spark):
    long = "lorem ipsum dolor sit amet " * 60_000
    rows = [(1, None), (2, ""), (3, "a"), (None, "no id at all"), (4, long), (2**60 + 1, "Ünï \U0001f600 日本語 \x00")]
    found = {r["doc_id"]: r for r in winnow.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        hashes, places = winnow.fingerprint(text or "")
        assert (found[i]["n_chars"], [h % 2**64 for h in found[i]["hashes"]], found[i]["places"]) == (len(text or ""), hashes.tolist(), places.tolist())
