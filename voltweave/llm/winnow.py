"""Document fingerprints by winnowing.

Every GRAM code points have a 64-bit hash, rolled up by doubling: a gram's hash is made of those of its two halves. Of every WINDOW
consecutive grams the one with the smallest hash (by its upper 40 bits) is kept, of equal ones the rightmost, with its position. What two
texts share over GRAM + WINDOW - 1 code points or more therefore shares a kept hash, at matching positions. A text with fewer grams than a
window keeps the smallest of all, one shorter than a gram the hash of the whole.

Comparing every document with the next one takes the next one's text. Texts are shuffled once, into ranges of the order; the first row
of each range also goes to the range before it, so that no document misses its neighbour. A range is read as a stream.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import mix
from .common import small_batches

GRAM, WINDOW = 32, 64
#: Code points that NumPy works on at once.
CHUNK = 1 << 20
#: Bytes of text in a range of documents.
RANGE = 32_000_000

_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 24) - 1)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(points: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all runs of `size` code points, from those of powers of two."""
    power = mix(points.astype(np.uint64) + np.uint64(1))
    out, done, length = None, 0, 1
    while True:
        if size & length:
            if out is None:
                out, done = power, length
            else:
                out = out[: len(points) - done - length + 1] * np.uint64(pow(_BASE, length, 2**64)) + power[done:]
                done += length
        length *= 2
        if length > size:
            return mix(out)
        half = length // 2
        power = power[:-half] * np.uint64(pow(_BASE, half, 2**64)) + power[half:]


def fingerprint(text: str, gram: int = GRAM, window: int = WINDOW, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes and where their grams begin, in order of place; none for an empty text. Long texts are worked on in chunks."""
    points = code_points(text)
    if not len(points):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    gram = min(gram, len(points))
    window = min(window, len(points) - gram + 1)
    kept = []
    for first in range(0, len(points) - gram - window + 2, chunk):
        h = gram_hashes(points[first : first + chunk + gram + window - 2], gram)
        # The order of a window in one number: the hash's upper bits, then how far to the left.
        least, span = (h & ~_PLACE) | (_PLACE - np.arange(len(h), dtype=np.uint64)), 1
        while span < window:
            step = min(span, window - span)
            least, span = np.minimum(least[:-step], least[step:]), span + step
        at = (_PLACE - (least & _PLACE)).astype(np.int64)
        at = at[np.concatenate(([True], at[1:] != at[:-1]))]
        kept.append((h[at], at + first))
    hashes, at = (np.concatenate(x) for x in zip(*kept, strict=True))
    new = np.concatenate(([True], at[1:] != at[:-1]))
    return hashes[new], at[new]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the distinct hashes of either that both keep; 1 if neither keeps any."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def digest(hashes: np.ndarray, places: np.ndarray) -> str:
    """A fingerprint as text: eight hexadecimal digits of each hash, eight of its place, comma-joined."""
    both = np.stack([(hashes >> np.uint64(32)).astype(">u4"), places.astype(">u4")], 1)
    return both.tobytes().hex(",", 8)


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id, n_chars, hashes (array<long>), places (array<long>) of every row's whole text; nothing is shuffled.

    Null text counts as empty and keeps no hash. Repeated rows give equal rows, a null doc_id stays null. Other columns aren't read. An empty
    table gives an empty result.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("n_chars long, hashes array<long>, places array<long>")
    def kept(texts: pd.Series) -> pd.DataFrame:
        found = [fingerprint(t, gram, window) for t in texts]
        return pd.DataFrame({"n_chars": texts.str.len(), "hashes": [h.view(np.int64) for h, _ in found], "places": [p for _, p in found]})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.withColumn("f", kept("text")).select("doc_id", "f.n_chars", "f.hashes", "f.places")


_REPORT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _pairs(gram: int, window: int):
    """Rows in order, each with the one after it; a copy is only the next of the row before."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None
        for b in batches:
            rows = []
            for no_id, doc_id, text, copy in zip(b["no_id"], b["doc_id"], b["text"], b["copy"], strict=True):
                same = before is not None and before[1] == text
                now = (None if no_id else doc_id, text, before[2] if same else fingerprint(text, gram, window))
                if before is not None:
                    share = len(before[1]) // 4
                    edited = before[1][: len(before[1]) - share] + text[:share]
                    theirs = before[2] if edited == before[1] else fingerprint(edited, gram, window)
                    rows.append((before[0], len(before[1]), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), digest(*before[2]), digest(*theirs), likeness(before[2][0], theirs[0]), 1.0 if same else likeness(before[2][0], now[2][0])))
                before = None if copy else now
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _REPORT.split(", ")], dtype=object).astype({"doc_id": "Int64"})

    return run


def edit_report(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the next document.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row of docs (doc_id, text). The next
    document is that of the next doc_id, null ones last, rows of one id in the order of a hash of their text; after the last comes the first. The edited text has its last
    floor(n_chars / 4) code points replaced by the first as many of the next document, all of it if it is shorter. Null text is empty; two empty
    texts are alike (1), an empty and another aren't (0). Repeated rows are neighbours, in one range, which is read as a stream. A single
    row is its own next. Other columns aren't read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = ["no_id", "doc_id", "h"]
    # Ids beside a flag for null ones: Python would get longs with nulls among them as doubles.
    rows = texts.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    if size is None:
        return spark.createDataFrame([], _REPORT)
    # One key a range comes to the driver: the first of each, found on keys alone.
    ranges = rows.select(*order).repartitionByRange(max(spark.sparkContext.defaultParallelism, -(-int(size) // RANGE)), *order)
    firsts = sorted(tuple(r["k"]) for r in ranges.groupBy(F.spark_partition_id()).agg(F.min(F.struct(*order)).alias("k")).collect())

    @F.pandas_udf("part int, first boolean")
    def place(no_id: pd.Series, doc_id: pd.Series, h: pd.Series) -> pd.DataFrame:
        keys = list(zip(no_id.tolist(), doc_id.tolist(), h.tolist(), strict=True))
        at = [max(0, bisect_right(firsts, k) - 1) for k in keys]
        return pd.DataFrame({"part": at, "first": [k == firsts[i] for k, i in zip(keys, at, strict=True)]})

    n = len(firsts)
    own = F.struct(F.col("p.part").alias("part"), F.lit(False).alias("copy"))
    also = F.struct(F.pmod(F.col("p.part") - 1, F.lit(n)).alias("part"), F.lit(True).alias("copy"))
    # Rows alike in id and text begin a range together; one of them is enough as the next of the range before.
    dealt = rows.withColumn("p", place(*[F.col(c) for c in order])).select(F.explode(F.when(F.col("p.first"), F.array(own, also)).otherwise(F.array(own))).alias("d"), *order, "text")
    dealt = dealt.select("d.part", "d.copy", *order, "text").repartitionById(n, F.col("part")).sortWithinPartitions("copy", *order)
    return dealt.select("no_id", "doc_id", "text", "copy").mapInPandas(_pairs(gram, window), _REPORT)
