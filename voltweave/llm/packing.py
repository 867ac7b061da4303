"""Packing documents into training sequences by lexical retrieval.

Texts become token ids in one pass, two bytes each. BM25's document frequencies and mean length are those of the whole corpus. Documents
are dealt by content into shards of about SHARD bytes of text: clusters of their BM25-weighted ids, projected to DIMENSIONS numbers; a large
cluster is parted by a MinHash of the ids under their weights, and what is still large (copies) by a hash. A shard holds an inverted index over
its documents' ids. A seed document opens a window; the unused documents of its shard that score highest for it fill the window one after the
other. The last one is cut where the window ends, and its rest is the next seed. So windows hold texts that share their words, and only a
shard's last sequence has padding.
"""

from __future__ import annotations

import itertools
import json
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import Lookup, words
from .common import discard, give_back, small_batches, staged

WINDOW = 4096
SHARD = 5_000_000
#: BM25's saturation and length parameters; an index marks ids in at most COMMON of its documents as telling. Packing asks for all ids: common ones have a low idf.
K1, B, COMMON = 1.2, 0.75, 0.2
#: An id that over 1 / DENSE of a shard's documents hold has a row of weights for all of them.
DENSE = 8
#: Words that a worker remembers the ids of, within a task, at about 30 bytes each; bytes of text that are looked up together.
REMEMBER, SLICE = 1_000_000, 1_000_000
#: Words of more bytes of letters go to the tokenizer itself.
LETTERS = 40
#: Numbers that a document's ids are projected to for clustering; clusters that one is parted in; documents that the clusters' centres come from, whatever the input.
DIMENSIONS, BRANCH, SAMPLE = 64, 8, 16_000

MARKS = ".,;:!?%$&*#|"

#: Byte-level vocabularies write bytes that aren't printable, in their order, as the characters from 256 on.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = dict(zip((b for b in range(256) if b not in _PLAIN), range(256, 512), strict=False))

_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(MARKS.encode())] = True

_TOKENIZERS: dict[str, WordTokenizer] = {}


class Merges:
    """Byte-pair merges of many words at once: in every round, each word merges its pair of the lowest rank, the leftmost of equals."""

    #: Words that are merged together; a rank that no pair has.
    TOGETHER, NEVER = 4_000, 1 << 30

    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = [vocab[a] << 32 | vocab[b] for a, b in pairs]
        # Of a pair that is listed twice, the first counts.
        rank = {k: r for r, k in reversed(list(enumerate(keys)))}
        self.ranks = Lookup(np.array(list(rank), np.uint64), np.array(list(rank.values()), np.int32))
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        chars = [chr(_BYTES.get(i, i)) for i in range(256)]
        self.inner, self.last = (np.array([vocab[c + end] for c in chars], np.int32) for end in ("", "</w>"))

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = self.ranks.get((a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)).ravel(), self.NEVER)
        return found.astype(np.int32).reshape(a.shape)

    def __call__(self, raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of at least one byte, one word's after the other's, and how many each has."""
        order, parts = np.argsort(length, kind="stable"), []
        count = np.zeros(len(start), np.int64)
        for at in range(0, len(order), self.TOGETHER):
            part = order[at : at + self.TOGETHER]
            n = length[part]
            ids = np.full((len(part), int(n[-1])), -1, np.int32)
            ids[np.arange(ids.shape[1]) < n[:, None]] = self.inner[raw[ranges(start[part], n)]]
            ids[np.arange(len(part)), n - 1] = self.last[raw[start[part] + n - 1]]
            ids, count[part] = self._merged(ids, n)
            parts.append((part, ids[np.arange(ids.shape[1]) < count[part][:, None]]))
        out, first = np.empty(int(count.sum()), np.int64), np.cumsum(count) - count
        for part, ids in parts:
            out[ranges(first[part], count[part])] = ids
        return out, count

    def _merged(self, ids: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length, width = length.copy(), ids.shape[1]
        if width < 2:
            return ids, length
        rows, now = np.arange(len(ids)), ids.copy()
        ranks = np.where(now[:, 1:] >= 0, self._rank(now[:, :-1], np.maximum(now[:, 1:], 0)), np.int32(self.NEVER))
        columns = np.arange(width)
        while len(rows):
            at = ranks.argmin(1)
            least = ranks[np.arange(len(rows)), at]
            on = least < self.NEVER
            if not on.all():
                ids[rows[~on]] = now[~on]
                rows, now, ranks, at, least = rows[on], now[on], ranks[on], at[on], least[on]
            if not len(rows):
                break
            r = np.arange(len(rows))
            # What follows the merged pair moves up by one place.
            past = columns > at[:, None]
            shifted = np.concatenate([now[:, 1:], np.full((len(rows), 1), -1, np.int32)], 1)
            now = np.where(past, shifted, now)
            now[r, at] = self.made[least]
            moved = np.concatenate([ranks[:, 1:], np.full((len(rows), 1), self.NEVER, np.int32)], 1)
            ranks = np.where(past[:, :-1], moved, ranks)
            length[rows] -= 1
            for place in (at - 1, at):
                ok = np.flatnonzero((place >= 0) & (place < width - 1))
                p = place[ok]
                second = now[ok, p + 1]
                ranks[ok, p] = np.where(second >= 0, self._rank(now[ok, p], np.maximum(second, 0)), self.NEVER)
        return ids, length


class WordTokenizer:
    """Ids of whole texts by a tokenizer that parts words at white space, with the words' ids remembered.

    Exact where the tokenizer drops white space and normalises within words, as word_bpe_49k.json does. Words of Latin-1 letters, with
    or without marks at their end, are merged many at once: its normaliser does no more to them than lower case, and its splitter parts
    the marks. All other words go to the tokenizer itself. Words are known by 64-bit hashes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        model = json.loads(self.tokenizer.to_str())["model"]
        self.merges = Merges(model["vocab"], model["merges"])
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.forget()

    def forget(self) -> None:
        """Sorted hashes of the words known, where the ids of each begin, how many they are, and all ids."""
        self.hashes, self.first, self.count, self.ids = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, self.dtype)

    def _ask(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.int64), np.array([len(ids) for ids in found], np.int64)

    def _words(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of the lower-case bytes, one word's after the other's, and how many each has."""
        length = end - start
        at = ranges(start, length)
        before = np.cumsum(length) - length
        byte, lead = raw[at], raw[at - 1] == 195
        letter = ((byte >= 97) & (byte <= 122)) | (byte == 195) | (lead & (byte >= 159) & (byte <= 191) & (byte != 183))
        letter &= ~(lead & (byte == 195))
        mark = _IS_MARK[byte]
        letters = np.add.reduceat(letter.astype(np.int64), before)
        marks = np.add.reduceat(mark.astype(np.int64), before)
        last_letter = np.maximum.reduceat(np.where(letter, at, -1), before)
        plain = (letters > 0) & (marks <= 7) & (letters <= LETTERS) & (letters + marks == length) & (last_letter == start + letters - 1)
        count, put = np.zeros(len(start), np.int64), []

        easy, hard = np.flatnonzero(plain), np.flatnonzero(~plain)
        stem_ids, stem_count = self.merges(raw, start[easy], letters[easy])
        # Marks as numbers, the bytes one after the other: few are distinct.
        code = np.zeros(len(easy), np.int64)
        for i in range(7):
            more = np.flatnonzero(marks[easy] > i)
            code[more] = code[more] << 8 | raw[start[easy[more]] + letters[easy[more]] + i]
        codes, which = np.unique(code, return_inverse=True)
        mark_ids, mark_count = self._ask([int(c).to_bytes(7, "big").lstrip(b"\0").decode() for c in codes])
        count[easy] = stem_count + mark_count[which]
        texts = [raw[a:b].tobytes().decode() for a, b in zip(start[hard].tolist(), end[hard].tolist(), strict=True)]
        hard_ids, count[hard] = self._ask(texts)
        out, first = np.empty(int(count.sum()), np.int64), np.cumsum(count) - count
        out[ranges(first[easy], stem_count)] = stem_ids
        out[ranges(first[easy] + stem_count, mark_count[which])] = mark_ids[ranges((np.cumsum(mark_count) - mark_count)[which], mark_count[which])]
        out[ranges(first[hard], count[hard])] = hard_ids
        return out, count

    def _encode(self, raws: list[bytes]) -> list[bytes]:
        """Of pieces of text whose ends part words; together not much longer than SLICE."""
        # A break before each: what comes before a word's first byte is never a byte of another word.
        raw = np.frombuffer(b"\n" + b"\n".join(raws) + b"\n", np.uint8).copy()
        raw[(raw >= 65) & (raw <= 90)] += 32
        # Capital letters of Latin-1 after their lead byte.
        high = np.flatnonzero(raw == 195) + 1
        high = high[(raw[high] >= 128) & (raw[high] <= 158) & (raw[high] != 151)]
        raw[high] += 32
        start, end, hashes = words(raw)
        distinct, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
        fresh = np.flatnonzero(self.hashes[place] != distinct) if len(self.hashes) else np.arange(len(distinct))
        if len(self.hashes) + len(fresh) > REMEMBER and len(self.hashes):
            self.forget()
            return self._encode(raws)
        if len(fresh):
            ids, count = self._words(raw, start[one[fresh]], end[one[fresh]])
            at = np.searchsorted(self.hashes, distinct[fresh])
            self.hashes, self.count = np.insert(self.hashes, at, distinct[fresh]), np.insert(self.count, at, count)
            self.first = np.insert(self.first, at, len(self.ids) + np.cumsum(count) - count)
            self.ids = np.concatenate([self.ids, ids.astype(self.dtype)])
        place = np.searchsorted(self.hashes, distinct)[which]
        count = self.count[place]
        ids = self.ids[ranges(self.first[place], count)]
        ends = np.cumsum([len(r) + 1 for r in raws])
        ends = np.concatenate(([0], np.cumsum(count)))[np.searchsorted(start, ends + 1)].tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian numbers."""
        pieces: list[bytes] = []
        many = []
        for text in texts:
            cut = list(_cut(text.encode("utf-8", "replace")))
            many.append(len(cut))
            pieces += cut
        out, at = [], 0
        while at < len(pieces):
            n, size = 0, 0
            while at + n < len(pieces) and (not n or size + len(pieces[at + n]) <= SLICE):
                size += len(pieces[at + n])
                n += 1
            out += self._encode(pieces[at : at + n])
            at += n
        rest = iter(out)
        return [b"".join(itertools.islice(rest, n)) for n in many]


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first[i] to first[i] + count[i] - 1, for one i after the other."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _cut(raw: bytes) -> Iterator[bytes]:
    """A text's bytes in pieces of about SLICE, parted at blanks or line breaks."""
    while len(raw) > SLICE:
        at = max(raw.rfind(b" ", 1, SLICE), raw.rfind(b"\n", 1, SLICE))
        if at < 0:
            at = min((i for i in (raw.find(b" ", SLICE), raw.find(b"\n", SLICE)) if i >= 0), default=len(raw))
        yield raw[:at]
        raw = raw[at:]
    yield raw


def tokenizer_at(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _tokenize(path: str, end_id: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer_at(path)
        end = np.array([end_id], t.dtype).tobytes()
        for b in batches:
            give_back()
            ids = t.encode(b["text"].tolist())
            yield pd.DataFrame({"doc_id": b["doc_id"], "size": b["size"], "ids": [x + end for x in ids]})
        t.forget()
        give_back()

    return run


def _count(dtype: str) -> Callable:
    """Arrays of ids to (id, documents that hold it, occurrences), summed over a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        add = lambda x, y: y + np.pad(x, (0, len(y) - len(x))) if len(x) < len(y) else x + np.pad(y, (0, len(x) - len(y)))
        for b in batches:
            for i in range(0, len(b), 1000):
                term, tf, _, _ = postings(b["ids"].iloc[i : i + 1000].tolist(), dtype)
                df, total = add(df, np.bincount(term)), add(total, np.bincount(term, tf).astype(np.int64))
            give_back()
        there = np.flatnonzero(total)
        yield pd.DataFrame({"id": there, "df": df[there], "total": total[there]})

    return run


def terms_of(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids of a document that isn't empty, ascending, and how often each occurs."""
    ids = np.sort(doc, kind="stable")
    edge = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    return ids[edge], np.diff(edge, append=len(ids))


def postings(ids: list[bytes], dtype: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ids of each document, one document's after the other's, how often each occurs, where a document's begin (and all end), and the documents' lengths."""
    docs = [np.frombuffer(x, dtype) for x in ids]
    length = np.array([len(d) for d in docs])
    keys, tf = np.unique(np.repeat(np.arange(len(docs)), length) << 32 | np.concatenate(docs).astype(np.int64), return_counts=True)
    return keys & 0xFFFFFFFF, tf, np.searchsorted(keys, np.arange(len(docs) + 1) << 32), length


class Statistics:
    """BM25's of a whole corpus: documents, their mean length, and documents by id; as long as the vocabulary, whatever the input."""

    def __init__(self, n: int, mean: float, df: np.ndarray):
        self.n, self.mean, self.df = n, mean, df

    def idf(self) -> np.ndarray:
        return np.log1p((self.n - self.df + 0.5) / (self.df + 0.5))


def statistics(ids: DataFrame, dtype: str) -> Statistics:
    """Of the column ids of a table."""
    counts = ids.select("ids").mapInPandas(_count(dtype), "id long, df long, total long").groupBy("id").agg(F.sum("df").alias("df"), F.sum("total").alias("total")).toPandas()
    n = ids.count()
    df = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 1, np.int64)
    df[counts["id"]] = counts["df"]
    return Statistics(n, float(counts["total"].sum()) / max(1, n), df)


class Place:
    """Where a document's content puts it: a vector of unit length, and a key that documents share with probability as their weighted ids overlap."""

    def __init__(self, stats: Statistics, dtype: str):
        self.idf, self.mean, self.dtype = np.where(stats.df > 1, stats.idf(), 0.0), stats.mean, dtype
        rng = np.random.default_rng(20240302)
        self.signs = rng.choice(np.array([-1, 1], np.float32), (len(stats.df), DIMENSIONS))
        self.draw = rng.exponential(size=len(stats.df)) / np.maximum(self.idf, 1e-9)

    def __call__(self, ids: list[bytes]) -> Iterator[tuple[np.ndarray, int]]:
        """Of each document."""
        for i in range(0, len(ids), 500):
            term, tf, edge, length = postings(ids[i : i + 500], self.dtype)
            weight = self.idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * np.repeat(length, np.diff(edge)) / self.mean))
            weight, draw = weight.astype(np.float32), self.draw[term]
            for a, b in itertools.pairwise(edge.tolist()):
                vector = weight[a:b] @ self.signs[term[a:b]]
                yield vector / max(float(np.linalg.norm(vector)), 1e-9), int(term[a + draw[a:b].argmin()])


def _vectors(stats: Statistics, dtype: str) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = Place(stats, dtype)
        for b in batches:
            yield pd.DataFrame({"ids_hash": b["ids_hash"], "vector": [v for v, _ in place(b["ids"].tolist())]})
            give_back()

    return run


def _centres(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from vectors spread over the sample; the same in each run."""
    centres = vectors[np.linspace(0, len(vectors) - 1, k).astype(int)]
    for _ in range(8):
        at = (vectors @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, vectors)
        long = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(long > 1e-6, sums / np.maximum(long, 1e-6), centres)
    return centres


def _tree(vectors: np.ndarray, shards: float, leaves: Iterator[int]) -> tuple[np.ndarray, list] | int:
    """Centres with what is under each, parted until a leaf's share of the vectors is about one shard; a leaf is its number."""
    k = min(BRANCH, math.ceil(shards), len(vectors))
    if k < 2:
        return next(leaves)
    centres = _centres(vectors, k)
    at = (vectors @ centres.T).argmax(1)
    counts = np.bincount(at, minlength=k)
    if counts.max() == len(vectors):
        return next(leaves)
    return centres, [_tree(vectors[at == i], shards * counts[i] / len(vectors), leaves) for i in range(k)]


def _assign(stats: Statistics, dtype: str, tree: tuple[np.ndarray, list] | int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = Place(stats, dtype)
        for b in batches:
            found = []
            for vector, key in place(b["ids"].tolist()):
                node = tree
                while not isinstance(node, int):
                    node = node[1][int((node[0] @ vector).argmax())]
                found.append((node, key))
            yield b.assign(cluster=[c for c, _ in found], key=[k for _, k in found])
            give_back()

    return run


def deal(ids: DataFrame, stats: Statistics, dtype: str) -> DataFrame:
    """A table (doc_id, size, ids), removed here if it is staged and written anew, to (doc_id, ids, shard): shards of about SHARD bytes of text, documents with like content together."""
    size = ids.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-int(size) // SHARD))
    if shards == 1:
        return ids.select("doc_id", "ids", F.lit(0).alias("shard"))
    content = F.xxhash64("ids").alias("ids_hash")
    rare = ids.select("ids", content).where(F.pmod("ids_hash", F.lit(max(1, stats.n // SAMPLE))) == 0)
    sample = rare.dropDuplicates(["ids_hash"]).mapInPandas(_vectors(stats, dtype), "ids_hash long, vector array<float>").toPandas().sort_values("ids_hash")
    tree = _tree(np.stack(sample["vector"].to_list()).astype(np.float32), shards, itertools.count()) if len(sample) else 0
    placed = staged(ids.mapInPandas(_assign(stats, dtype, tree), "doc_id long, size long, ids binary, cluster int, key long"), "placed")
    if hasattr(ids, "staged_path"):
        discard(ids)
    parts = placed.groupBy("cluster").agg(F.ceil(F.sum("size") / SHARD).cast("int").alias("parts"))
    placed = placed.join(F.broadcast(parts), "cluster").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    # About as many rows as clusters and shards: small beside the ids, which a shuffle for the joins would write once more.
    sizes = sorted(placed.groupBy("cluster", "part").agg(F.sum("size")).collect())
    numbers, shard, fill = [], 0, 0
    for cluster, part, n in sizes:
        if fill and fill + n > 1.5 * SHARD:
            shard, fill = shard + 1, 0
        salts = max(1, round(n / SHARD))
        numbers.append((cluster, part, shard, salts))
        shard, fill = (shard + salts, 0) if salts > 1 else (shard, fill + n)
    numbers = ids.sparkSession.createDataFrame(numbers, "cluster int, part int, first_shard int, salts int")
    placed = placed.join(F.broadcast(numbers), ["cluster", "part"])
    alone = placed.where("salts = 1").select("doc_id", "ids", F.col("first_shard").alias("shard"))
    # A part that is still large: equal rows, however many, are counted first and go to all of its shards in turn.
    large = placed.where("salts > 1").groupBy("doc_id", "ids", "first_shard", "salts").agg(F.count("*").alias("n"))
    salt = F.pmod(F.xxhash64("doc_id", "ids") + F.col("turn"), F.col("salts"))
    large = large.withColumn("turn", F.explode(F.expr("sequence(1, n)"))).select("doc_id", "ids", (F.col("first_shard") + salt).cast("int").alias("shard"))
    return alone.union(large)


class Index:
    """BM25 over documents given by their arrays of ids, with the statistics of these or of a corpus that they are from."""

    def __init__(self, docs: list[np.ndarray], stats: Statistics | None = None, common: float = COMMON):
        terms, counts = zip(*((t, c.astype(np.int32)) for t, c in map(terms_of, docs)), strict=True)
        self.terms, n = terms, len(docs)
        term, tf, owner = np.concatenate(terms), np.concatenate(counts), np.repeat(np.arange(n, dtype=np.int32), [len(t) for t in terms])
        del counts
        length = np.array([len(d) for d in docs], float)
        order = np.argsort(term, kind="stable")
        df = np.bincount(term)
        stats = stats or Statistics(n, length.mean(), df)
        weight = stats.idf()[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[owner] / stats.mean))
        self.owner, self.weight, self.df = owner[order], weight[order], df
        self.start = np.concatenate(([0], np.cumsum(df)))
        self.telling, self.n = df <= max(1, common * n), n
        # Ids of many documents as rows of a matrix, which has at most DENSE cells for each posting.
        often = np.flatnonzero((df * DENSE > n) & self.telling)
        self.row = np.full(len(df), -1)
        self.row[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), n), np.float32)
        at = ranges(self.start[often], df[often])
        self.dense[np.repeat(np.arange(len(often)), df[often]), self.owner[at]] = self.weight[at]

    def scores(self, doc: int) -> np.ndarray:
        """Of every document, for the ids of one."""
        t = self.terms[doc].astype(np.int64)
        t = t[self.telling[t]]
        row = self.row[t]
        t = t[row < 0]
        at = ranges(self.start[t], self.df[t])
        return np.bincount(self.owner[at], self.weight[at], self.n) + self.dense[row[row >= 0]].sum(0)


def pack_shard(docs: list[np.ndarray], window: int, stats: Statistics | None = None, apart: bool = False) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that hold every id of the documents once; only the last sequence isn't full.

    A copy is its document's best neighbour; where copies are to be apart, no window gets a copy of what it holds while other documents are left.
    """
    # Copies are one document of the index.
    first: dict[bytes, int] = {}
    same = np.array([first.setdefault(d.tobytes(), len(first)) for d in docs])
    index, unused = Index([docs[i] for i in np.unique(same, return_index=True)[1]], stats, 1.0), np.ones(len(docs), bool)
    pieces, sequence, fill, seed, pos, turn = [], 0, 0, -1, 0, 0
    held: set[int] = set()

    def place(doc: int, at: int) -> int:
        """Puts what fits of the document from `at` on; how far it came."""
        nonlocal sequence, fill
        n = min(len(docs[doc]) - at, window - fill)
        pieces.append((doc, at, n, sequence, fill))
        if apart:
            held.add(int(same[doc]))
        fill += n
        if fill == window:
            sequence, fill = sequence + 1, 0
            held.clear()
        return at + n

    def next_in_line() -> int:
        """The first unused document that the window holds no copy of, or else the first one; -1 if all are used."""
        nonlocal turn
        while turn < len(docs) and not unused[turn]:
            turn += 1
        if turn == len(docs) or int(same[turn]) not in held:
            return turn if turn < len(docs) else -1
        others = np.flatnonzero(unused[turn:] & ~np.isin(same[turn:], list(held)))
        return turn + int(others[0]) if len(others) else turn

    while True:
        if seed < 0:
            seed = next_in_line()
            if seed < 0:
                return pieces
            pos, unused[seed] = 0, False
        while pos < len(docs[seed]) and fill + len(docs[seed]) - pos >= window:
            pos = place(seed, pos)
        if pos == len(docs[seed]):
            seed = -1
            continue
        place(seed, pos)
        scores = np.where(unused, index.scores(same[seed])[same], -1.0)
        asked, seed = 16, -1
        while fill and seed < 0:
            best = np.argpartition(-scores, min(asked, len(docs) - 1))[:asked] if asked < len(docs) else np.arange(len(docs))
            best = best[np.lexsort((best, -scores[best]))]
            best = best[(scores[best] > 0) & unused[best]]
            for doc in best.tolist():
                if int(same[doc]) in held:
                    continue
                unused[doc] = False
                pos = place(doc, 0)
                if pos < len(docs[doc]):
                    seed = doc
                if not fill or seed >= 0:
                    break
            if asked >= len(docs) or not len(best):
                break  # no neighbour is left: the next document in line carries the window on
            asked *= 4


def _pack(window: int, dtype: str, with_ids: bool, stats: Statistics, apart: bool) -> Callable:
    def run(key, shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["doc_id", "ids"], na_position="last", kind="stable")
        docs = [np.frombuffer(x, dtype) for x in shard["ids"]]
        doc_ids, rows = shard["doc_id"].tolist(), []
        del shard
        give_back()
        pieces = pack_shard(docs, window, stats, apart)
        give_back()
        for doc, start, n, sequence, offset in pieces:
            ids = docs[doc][start : start + n].astype("<u4")
            rows.append((doc_ids[doc], start, n, zlib.crc32(ids.tobytes()), len(docs[doc]), (int(key[0]) << 32) + sequence, offset) + ((ids.astype(np.int32),) if with_ids else ()))
        columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
        return pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, window: int = WINDOW, with_ids: bool = True, apart: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    A document is its text's ids and end_id; null or empty text is end_id alone. Repeated rows are packed as often as they
    occur; a null doc_id is kept. Pieces of a sequence follow each other from offset 0 without gaps. Other columns
    aren't read. An empty table gives no pieces. With `apart`, no sequence gets a copy of what it
    holds while its shard has other documents left. The result is the same in each run.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), text.alias("text"))
    dtype = tokenizer_at(tokenizer_path).dtype
    ids = staged(rows.mapInPandas(_tokenize(tokenizer_path, end_id), "doc_id long, size long, ids binary"), "ids")
    stats = statistics(ids, dtype)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    return deal(ids, stats, dtype).groupBy("shard").applyInPandas(_pack(window, dtype, with_ids, stats, apart), schema)
