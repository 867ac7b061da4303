"""Phrase collocations: word sequences that are more frequent than any cut into two parts makes likely.

1. Texts become rows of about SPLIT words, each a 64-bit key of language and word, pieces kept apart. A longer phrase's key is made of
   those of its first and last words but one.
2. Candidates, level by level: phrases both of whose sub-phrases are candidates, and that are frequent enough. A row reports each phrase once, with
   its count, in turns by the phrase's key: what a turn shuffles is at most 1 / TURNS of the text's words, however many of its phrases are frequent.
   Rows are written once, when the frequent words are known, without the others.
3. Candidates of all levels get a minimal perfect hash: bits in a few levels, a key's slot is the rank of its bit. Each slot stores its key, so that
   other phrases are told apart. Tasks count slots with bincount, and note at each slot its phrase's parts; the arrays are summed up as a tree,
   in blocks of slots.
4. A frequent phrase's parts are frequent, so every cut's counts are among these: they are read level by level from the two
   sub-phrases. Scores are exact decimals.

What tasks get at once is bounded: SLOTS candidates (more are counted in turns, each a pass over the rows), and for the sub-phrases a bitmap of 16 MB at
most, of which a false hit lets a candidate in that nothing counts.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .bytewords import lower_bytes, mix, words
from .common import discard, free_shuffles, give_back, small_batches, staged

SPLIT = 1 << 18
SLOTS = 1 << 21
#: A turn's reports are at most one for so many words of the text.
TURNS = 3
#: Words that NumPy works on at once.
SLICE = 1 << 16
#: Slots of a block of counts, arrays that are summed up at once.
BLOCK, FAN = 1 << 15, 64
#: Bits of a bitmap, as a power of two.
LEAST_BITS, MOST_BITS = 16, 27
#: Bytes of text that NumPy works on at once.
CHUNK = 500_000
#: Bytes of rows that a Python worker gets at once, where the session has Spark's 64 MB.
BYTES = "8m"
_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"

_END = np.zeros(256, bool)
_END[[ord(c) for c in ".,;:!?"] + list(range(10, 14))] = True
_APART = _END.copy()
_APART[[9, 32]] = True
_FIRST, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def language_key(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "replace"), digest_size=8).digest(), "little"))


def word_keys(texts: list[str | None], lang: str) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By chunks of whole texts: bytes, start and end of each word, its key, and whether a piece begins with it."""
    raws, size = [], 0
    for i, text in enumerate(texts):
        raws.append(lower_bytes(text))
        size += len(raws[-1]) + 1
        if size >= CHUNK or i == len(texts) - 1:
            data = b"\n".join(raws)
            raw = np.frombuffer(data, np.uint8)
            start, end, h = words(raw, _APART)
            key = mix(h ^ language_key(lang))
            key[key == 0] = 1
            piece = np.cumsum(_END[raw])[start] if len(start) else start
            yield data, start, end, key, np.concatenate(([True], piece[1:] != piece[:-1]))[: len(start)]
            raws, size = [], 0


_ROWS = "lang string, tongue long, n_words long, data binary"


def _encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (lang, tongue, n_words, data): the language and its key, compressed keys of words, 0 before each piece."""
    held: dict[str, list[np.ndarray]] = {}
    sizes: dict[str, int] = {}

    def flush(langs: list[str]) -> pd.DataFrame:
        rows = [(lang, int(language_key(lang).view(np.int64)), sizes.pop(lang), zlib.compress(np.concatenate(held.pop(lang)), 1)) for lang in langs]
        return pd.DataFrame(rows, columns=["lang", "tongue", "n_words", "data"])

    for b in batches:
        for lang, some in b.groupby("lang")["text"]:
            for _, _, _, key, begins in word_keys(some.tolist(), lang):
                held.setdefault(lang, []).append(np.insert(key, np.flatnonzero(begins), np.uint64(0)))
                sizes[lang] = sizes.get(lang, 0) + len(key)
                if sizes[lang] >= SPLIT:
                    yield flush([lang])
        if sum(sizes.values()) > 2 * SPLIT:
            yield flush(list(sizes))
        give_back()
    if sizes:
        yield flush(list(sizes))


def _encoded(then):
    """Texts to what `then` makes of their rows, in one Python worker: rows of megabytes needn't pass through the JVM to a second one, and an executor
    has half as many workers."""
    return lambda batches: then(_encode(batches))


class Bits:
    """A bitmap of keys by their low bits."""

    def __init__(self, size: int, data: np.ndarray):
        self.mask, self.data = np.uint64(size - 1), data

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys & self.mask
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bitmap(keys: DataFrame, n: int) -> Bits:
    """The keys' bitmap, put together from blocks of 32,768 bits; at most 2^MOST_BITS bits come to the driver, however many keys."""
    size = 1 << min(MOST_BITS, max(LEAST_BITS, (16 * n).bit_length()))
    at = F.pmod("key", F.lit(size))
    blocks = keys.groupBy(F.expr(f"cast(pmod(key, {size}) div 32768 as int)").alias("block")).agg(F.bitmap_construct_agg(at % 32768).alias("bits")).collect()
    data = np.zeros(size // 8, np.uint8)
    for block, bits in blocks:
        data[block * 4096 : (block + 1) * 4096] = np.frombuffer(bits, np.uint8)
    return Bits(size, data)


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys, with the key stored at each slot.

    Each level has twice as many bits as keys are left; a key whose bit no other key takes stays there, the rest go on. Slots are ranks
    of the bits that are set.
    """

    def __init__(self, keys: np.ndarray):
        self.levels, before, rest = [], 0, keys
        while len(rest):
            size = max(64, 2 * len(rest))
            at = self._at(rest, len(self.levels), size)
            n = np.bincount(at, minlength=size)
            bit = n == 1
            rank = np.cumsum(bit) - bit + before
            self.levels.append((size, bit, rank.astype(np.int32)))
            before += int(bit.sum())
            rest = rest[~bit[at]]
        self.keys = np.zeros(len(keys), np.uint64)
        self.keys[self._slots(keys)] = keys

    @staticmethod
    def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level + 1) * int(_FIRST) % 2**64)) % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (size, bit, rank) in enumerate(self.levels):
            at = self._at(keys[todo], level, size)
            hit = bit[at]
            out[todo[hit]] = rank[at[hit]]
            todo = todo[~hit]
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the keys that are among those it was built from, -1 for others."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        out = self._slots(keys)
        return np.where((out >= 0) & (self.keys[out] == keys), out, -1)


def _levels(data: bytes, bits: list[Bits], most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """By slices of the row and levels: keys of phrases whose sub-phrases the bitmaps have, with those of their first and last words but one."""
    row = np.frombuffer(zlib.decompress(data), np.uint64)
    for begin in range(0, len(row), SLICE):
        at = np.flatnonzero(row[begin : begin + SLICE + most - 1]).astype(np.int32)
        key = row[begin + at]
        first = last = key
        for level in range(1, most + 1):
            if level > 1:
                there = bits[level - 2].has(key)
                ok = np.flatnonzero(there[:-1] & there[1:] & (at[1:] == at[:-1] + 1))
                first, last, at = key[ok], key[ok + 1], at[ok]
                key = mix(first * _FIRST + (last ^ (last >> np.uint64(32))) * _LAST + np.uint64(level))
            mine = int(np.searchsorted(at, SLICE))
            yield level, key[:mine], first[:mine], last[:mine]


_REPORTS = "key long, n long"


def _report(level: int, bits, turn: int = 0, turns: int = 1):
    """(key, n) of a row's phrases of this level whose keys have this turn."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for data in b["data"]:
                key = [x[1] for x in _levels(data, bits.value, level) if x[0] == level]
                key = np.concatenate([x[(x >> np.uint64(32)) % np.uint64(turns) == turn] for x in key]) if key else np.empty(0, np.uint64)
                key.sort()
                edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True]))) if len(key) else np.zeros(1, np.int64)
                n = np.diff(edge)
                for i in range(0, len(n), SLICE):
                    yield pd.DataFrame({"key": key[edge[:-1][i : i + SLICE]].view(np.int64), "n": n[i : i + SLICE]})
                del key, edge, n
            give_back()

    return run


#: What is known at each slot; all but the counts are the same wherever a phrase occurs, and 0 where it doesn't.
_ARRAYS = ("counts", "level", "tongue", "first", "last")


def _count(found, bits, most: int):
    """A task's arrays by slot, as blocks whose counts aren't all zero."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed, n = found.value, len(found.value.keys)
        arrays = {name: np.zeros(n, np.int64) for name in _ARRAYS}
        for b in batches:
            for tongue, data in zip(b["tongue"].tolist(), b["data"], strict=True):
                for level, key, first, last in _levels(data, bits.value, most):
                    slots = hashed.slots(key)
                    there = slots >= 0
                    slots = slots[there]
                    arrays["counts"] += np.bincount(slots, minlength=n)
                    arrays["level"][slots], arrays["tongue"][slots] = level, tongue
                    arrays["first"][slots], arrays["last"][slots] = first[there].view(np.int64), last[there].view(np.int64)
            give_back()
        turn = TaskContext.get().partitionId()
        for i in range(0, n, BLOCK):
            if arrays["counts"][i : i + BLOCK].any():
                yield pd.DataFrame({"block": [i // BLOCK], "turn": [turn]} | {name: [a[i : i + BLOCK].tobytes()] for name, a in arrays.items()})
        del arrays
        give_back()

    return run


def _merged(df: pd.DataFrame) -> dict[str, np.ndarray]:
    """A block's arrays of several tasks in one: counts added, the rest from any task that has it."""
    out: dict[str, np.ndarray] = {}
    for row in df[list(_ARRAYS)].itertuples(index=False):
        arrays = {name: np.frombuffer(a, np.int64) for name, a in zip(_ARRAYS, row, strict=True)}
        if not out:
            out = {name: a.copy() for name, a in arrays.items()}
            continue
        new = (out["counts"] == 0) & (arrays["counts"] > 0)
        for name in _ARRAYS[1:]:
            out[name][new] = arrays[name][new]
        out["counts"] += arrays["counts"]
    return out


def _counted(rows: DataFrame, keys: np.ndarray, bits, most: int, least: int) -> DataFrame:
    """(key, f, level, tongue, first, last) of these candidates that occur at least `least` times."""
    spark = rows.sparkSession
    found = spark.sparkContext.broadcast(PerfectHash(keys))
    schema = f"block int, turn int, {', '.join(f'{name} binary' for name in _ARRAYS)}"
    arrays = rows.select("tongue", "data").mapInPandas(_count(found, bits, most), schema)

    def together(df: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": df["block"].iloc[:1], "turn": df["turn"].iloc[:1]} | {name: [a.tobytes()] for name, a in _merged(df).items()})

    for fan in (FAN, FAN * FAN):
        arrays = arrays.groupBy("block", F.expr(f"turn div {fan}")).applyInPandas(together, schema)

    def read(df: pd.DataFrame) -> pd.DataFrame:
        all_, first = _merged(df), int(df["block"].iloc[0]) * BLOCK
        often = np.flatnonzero(all_["counts"] >= least)
        return pd.DataFrame({"key": found.value.keys[first + often].view(np.int64), "f": all_["counts"][often]} | {name: all_[name][often] for name in _ARRAYS[1:]})

    return arrays.groupBy("block").applyInPandas(read, "key long, f long, level int, tongue long, first long, last long")


def _thin(frequent):
    """Rows without words that no candidate has; one 0 stands for what is left out between others."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            thin = []
            for data in b["data"]:
                row = np.frombuffer(zlib.decompress(data), np.uint64).copy()
                row[~frequent.value.has(row)] = 0
                thin.append(zlib.compress(row[(row != 0) | np.concatenate(([True], row[:-1] != 0))[: len(row)]], 1))
            yield b.assign(data=thin)
            give_back()

    return run


def candidates(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame, list[Bits], list[DataFrame]]:
    """(key) of all phrases that are candidates, the rows without rare words, and the bitmap of each level and the tables; rows are made twice, so they needn't
    be written."""
    spark, rows = docs.sparkSession, None
    bits, tables, turns = [], [], 1
    for level in range(1, longest + 1):
        sent, now, n, occur = spark.sparkContext.broadcast(list(bits)), [], 0, 0
        for turn in range(turns):
            report = _report(level, sent, turn, turns)
            reported = rows.select("data").mapInPandas(report, _REPORTS) if rows is not None else docs.mapInPandas(_encoded(report), _REPORTS)
            now.append(staged(reported.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least), f"level{level}"))
            some, often = now[-1].agg(F.count("*"), F.sum("n")).first()
            n, occur = n + some, occur + (often or 0)
            # Spark holds on to its last query until the next; that was the count, so the turn's shuffle goes now.
            del reported
            free_shuffles(spark)
        tables += now
        bits.append(bitmap(reduce(DataFrame.union, now), n))
        if level == 1:
            rows = staged(docs.mapInPandas(_encoded(_thin(spark.sparkContext.broadcast(bits[0]))), _ROWS), "thin", compression="uncompressed")
            total = rows.agg(F.sum("n_words")).first()[0] or 1
        # A phrase of the next level occurs only where one of this level does.
        turns = max(1, -(-TURNS * occur // total))
    return reduce(DataFrame.union, tables).select("key"), rows, bits, tables


def _names(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(key, word) of the words that needed (key) has."""
    asked = docs.sparkSession.sparkContext.broadcast(bitmap(needed, needed.count()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, some in b.groupby("lang")["text"]:
                for data, start, end, key, _ in word_keys(some.tolist(), lang):
                    u, at = np.unique(key, return_index=True)
                    hit = asked.value.has(u)
                    if hit.any():
                        yield pd.DataFrame({"key": u[hit].view(np.int64), "word": [data[start[i] : end[i]].decode("utf-8", "replace") for i in at[hit]]})
            give_back()

    return docs.mapInPandas(run, "key long, word string").groupBy("key").agg(F.min("word").alias("word")).join(needed, "key")


_RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, covered: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of two to `longest` words that occur at least `least` times.

    Texts are lower-cased (A-Z), cut into pieces at . , ; : ! ? and line ends, and those at blanks and tabs into words. n counts a language's words, a the
    phrase's occurrences inside pieces, overlaps included. A cut after the first k words has l and r, the occurrences of its parts, and
    the score floor(1000 * a * n / (l * r)); a phrase has its lowest-scoring cut's, of equal ones the first. Phrases inside a longer one that
    occurs at least `covered` percent as often are left out. Best score first, then a, then the phrase by its UTF-8 bytes.

    Null text is empty, null lang the language 'und'. Repeated rows count as often as they occur. Very long texts are read whole. Words, and
    phrases, are told apart by 64-bit keys. Counts must stay below 10^15. doc_id and other columns aren't read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    if spark.conf.get(_BYTES_KEY) == "67108864b":
        spark.conf.set(_BYTES_KEY, BYTES)
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    able, rows, bits, levels = candidates(docs, least, longest)
    totals = rows.groupBy("tongue", "lang").agg(F.sum("n_words").alias("n"))

    turns = max(1, -(-able.count() // SLOTS))
    sent, counted = spark.sparkContext.broadcast(bits), []
    for turn in range(turns):
        some = able.where(F.pmod(F.xxhash64("key"), F.lit(turns)) == turn).select("key")
        counted.append(staged(_counted(rows, some.toPandas()["key"].to_numpy(np.int64).view(np.uint64), sent, longest, least), "counts"))
    known = counted[0]
    for more in counted[1:]:
        known = known.union(more)
    grown = [staged(known.where("level = 1").select("tongue", "key", "f", F.array("key").alias("words"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"), F.array().cast("array<long>").alias("l"), F.array().cast("array<long>").alias("r")), "phrases1")]
    for level in range(2, longest + 1):
        # The counts of a phrase's beginnings are those of its first words but one and of all of these, and likewise from the end.
        p, s = (grown[-1].select("key", "f", "words", side).toDF(f"{name}_key", f"{name}_f", f"{name}_words", f"{name}_cuts") for name, side in (("p", "l"), ("s", "r")))
        now = known.where(F.col("level") == level).join(p, F.col("first") == F.col("p_key")).join(s, F.col("last") == F.col("s_key"))
        words_ = F.concat("p_words", F.array(F.element_at("s_words", -1)))
        now = now.select("tongue", "key", "f", words_.alias("words"), "first", "last", F.concat("p_cuts", F.array("p_f")).alias("l"), F.concat(F.array("s_f"), "s_cuts").alias("r"))
        grown.append(staged(now, f"phrases{level}"))

    phrases, longer = None, None
    for shorter in grown[1:]:
        inside = shorter.select(F.col("first").alias("key"), "f").union(shorter.select(F.col("last").alias("key"), "f"))
        longer = inside if longer is None else longer.union(inside)
        phrases = shorter if phrases is None else phrases.union(shorter)
    if phrases is None:
        return spark.createDataFrame([], _RESULT)
    # Every longer phrase around one has a phrase of one word more in between, at least as frequent.
    longer = longer.groupBy("key").agg(F.max("f").alias("f_longer"))
    kept = phrases.join(longer, "key", "left").where(F.coalesce(100 * F.col("f_longer") < covered * F.col("f"), F.lit(True)))
    kept = kept.join(totals, "tongue")
    score = "(cast(f as decimal(15,0)) * cast(n as decimal(15,0)) * 1000bd) div (cast(l[k] as decimal(15,0)) * cast(r[k] as decimal(15,0)))"
    cuts = F.expr(f"array_min(transform(sequence(0, size(l) - 1), k -> struct({score} as score, k as k, l[k] as l, r[k] as r)))")
    best = staged(kept.withColumn("c", cuts).select("lang", "key", "words", F.col("f").alias("a"), "n", "c.l", "c.r", "c.score"), "scored")

    names = _names(docs, staged(best.select(F.explode("words").alias("key")).distinct(), "named"))
    spelt = best.select("key", F.posexplode("words").alias("pos", "word_key")).join(names.withColumnRenamed("key", "word_key"), "word_key")
    spelt = spelt.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    out = best.join(spelt, "key").withColumn("rank", rank).where(F.col("rank") <= top)
    discard(rows, *levels, *counted, *grown)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
