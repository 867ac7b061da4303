"""Near-duplicate groups by MinHash with tensored banding, confirmed on full shingle sets.

1. One pass over the texts makes each document's set of word shingles (64-bit hashes), a 128-bit fingerprint of the set and
   MinHash values. Documents with equal sets form one class, which its smallest doc_id stands for.
2. The MinHash values make two collections of COLLECTION short keys each. A table key pairs one key of either collection, so
   COLLECTION ** 2 tables cost 2 * COLLECTION * HASHES hash functions. Documents at similarity s share a key with
   probability (1 - (1 - s^HASHES)^COLLECTION)^2, that is 0.9999 at s = 0.8.
3. Members of a bucket are compared with its smallest id only, confirmed on full sets, and connected. A document's home is the
   smallest id that it was found at least half similar to, so the members of a family of near copies, linked or not, share one.
4. Homes that hold several components: every pair of documents of different components, chunk against chunk of a home. A pair
   is met once, whatever the number of buckets it shares, and what a chunk has linked by then is passed over.
5. Buckets that still hold several components of several homes: the pairs across homes, each from the first bucket it shares. They
   travel as one document with a list of those of one block; a block is a chunk of the documents that were first compared with one.

So a family of n near copies costs n comparisons and n rows while it fits one chunk (WIDE documents, HEAVY shingles), and beyond that
rows by documents and chunks; what is compared pair by pair inside a chunk are only documents that no link has joined. No link between
different components is passed over.

Steps are written in between, so that each query has few joins: the driver plans a query anew after each of its shuffles, and its heap grows with that.

Comparisons drop pairs whose sizes, or whose similarities to a third document, rule a link out (exact), and pairs whose MinHash
values agree in fewer places than SURE (at the least similarity, 0.8, five pairs in a million). Nothing else is dropped, and no
bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytewords import lower_bytes, mix, words
from .common import discard, short_plans, small_batches, staged
from .components import connected_components

HASHES, COLLECTION = 2, 10
SIGNATURE = 2 * COLLECTION * HASHES
#: Of 40 values that agree with probability 0.8 each, under 20 agree in 5 cases of 10^6.
SURE = 20
#: Members of a bucket, or of a home, that are taken at once; shingles of a home likewise; partners of a document likewise.
WIDE, HEAVY, CHUNK = 1024, 1_000_000, 256
#: Documents whose table keys one task lays out and counts; a hundred each.
KEYED = 4_000
#: Rows, texts, shingles and pairs that one call of Python gets on average.
ROWS, TEXTS, SHINGLES, PAIRS = 20_000, 1_000, 500_000, 50_000
#: What is known of a bucket's member.
FIELDS = ("bucket", "id", "component", "csize", "home", "block", "to_centre", "n_shingles", "sig")

_DRAW = np.random.default_rng(20240301)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MULT = _DRAW.integers(0, 2**63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _DRAW.integers(0, 2**63, SIGNATURE, dtype=np.uint64)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of `size` words; fewer words make one shingle, none make none."""
    w = words(np.frombuffer(lower_bytes(text), np.uint8))[2]
    if not len(w):
        return w
    n = max(1, len(w) - size + 1)
    h = np.zeros(n, np.uint64)
    for i in range(min(size, len(w))):
        h = mix(h + w[i : i + n] + np.uint64(i + 1))
    return np.unique(h)


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """SIGNATURE MinHash values of a set that isn't empty."""
    out = np.full(SIGNATURE, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 4096):
        np.minimum(out, ((shingles[None, i : i + 4096] ^ _FLIP[:, None]) * _MULT[:, None]).min(1), out=out)
    return mix(out)


def _describe(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, text in zip(b["doc_id"], b["text"], strict=True):
                s = shingle_set(text, size)
                if len(s):
                    low, high = mix(s).sum(dtype=np.uint64), mix(s * _STEP + np.uint64(7)).sum(dtype=np.uint64)
                    rows.append((i, len(s), int(low.view(np.int64)), int(high.view(np.int64)), min_hashes(s).astype(np.uint32).view(np.int32)))
                else:
                    rows.append((i, 0, None, None, None))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "low", "high", "sig"]).astype({"doc_id": "Int64", "low": "Int64", "high": "Int64"})

    return run


def _bucket_keys(sig):
    """Table keys: each pair of a key of the first collection and one of the second, with the table's number in the low seven bits."""
    half = [[F.xxhash64(F.lit(c), F.lit(i), *[F.element_at(sig, (c * COLLECTION + i) * HASHES + j + 1) for j in range(HASHES)]) for i in range(COLLECTION)] for c in (0, 1)]
    keys = F.flatten(F.transform(F.array(*half[0]), lambda a: F.transform(F.array(*half[1]), lambda b: F.xxhash64(a, b))))
    return F.transform(keys, lambda k, i: k.bitwiseAND(F.lit(-128).cast("long")).bitwiseOR(i.cast("long")))


def _keyed(classes: DataFrame) -> DataFrame:
    """(id, bucket) of every table key. Files of classes are small for what they grow to, so their rows are dealt out first: counting keys takes
    memory by the keys of a task, and nearly all of them are met once."""
    tasks = max(1, -(-classes.count() // KEYED))
    return classes.select("id", "sig").repartition(tasks, "id").select("id", F.explode(_bucket_keys(F.col("sig"))).alias("bucket"))


def _agree(a, b):
    """In how many places two columns of MinHash values agree."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)


def _across(percent: int):
    """Pairs of a bucket's chunk against another chunk, of different components and homes, that may be similar.

    Left out: what sizes or MinHash values rule out; what the triangle inequality rules out, for 1 - similarity is a metric and
    the similarity to the bucket's centre is known; and what another bucket, the first that both are in, gives.
    """

    far_apart = 1 - percent / 100 + 1e-9

    def one(left: dict, right: dict) -> list[np.ndarray]:
        table, half, found = int(left["bucket"][0]) & 127, COLLECTION * HASHES, []
        for i in range(len(left["id"])):
            n = left["n"][i]
            far = np.abs(right["to_centre"] - left["to_centre"][i]) > far_apart  # not where either is unknown: nan
            ok = np.flatnonzero((right["home"] != left["home"][i]) & (right["component"] != left["component"][i]) & (100 * np.minimum(right["n"], n) >= percent * np.maximum(right["n"], n)) & ~far)
            if not len(ok):
                continue
            same = right["sig"][ok] == left["sig"][i]
            enough = same.sum(1) >= SURE
            ok, same = ok[enough], same[enough]
            keys = [same[:, h : h + half].reshape(-1, COLLECTION, HASHES).all(2).argmax(1) for h in (0, half)]
            ok = ok[keys[0] * COLLECTION + keys[1] == table]
            # The document of the smaller component asks; each pair of a chunk with itself is met twice.
            size, other = left["csize"][i], right["csize"][ok]
            asks = (size < other) | ((size == other) & (left["id"][i] < right["id"][ok]))
            mine, theirs, blocks = left["id"][i], right["id"][ok], right["block"][ok]
            found.append(np.stack(np.broadcast_arrays(mine, blocks[asks], theirs[asks]), 1))
            found.append(np.stack(np.broadcast_arrays(theirs[~asks], left["block"][i], mine), 1))
        return found

    def arrays(df: pd.DataFrame) -> tuple[dict, dict]:
        """Columns in the order of (bucket, i, j), and where each of those begins and ends."""
        df = df.set_axis(["slot", "i", "j", *FIELDS], axis=1).sort_values(["bucket", "i", "j"])
        out = {"n": df["n_shingles"].to_numpy(), "to_centre": df["to_centre"].to_numpy(float), "sig": np.stack(df["sig"].to_list())}
        out |= {c: df[c].to_numpy() for c in ("bucket", "id", "component", "csize", "home", "block")}
        keys = df[["bucket", "i", "j"]].to_numpy()
        first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1))))
        return out, {tuple(keys[a]): slice(a, b) for a, b in zip(first, [*first[1:], len(keys)], strict=True)}

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [np.empty((0, 3), np.int64)]
        if len(left) and len(right):
            (left, at_left), (right, at_right) = arrays(left), arrays(right)
            for key in at_left.keys() & at_right.keys():
                found += one({c: v[at_left[key]] for c, v in left.items()}, {c: v[at_right[key]] for c, v in right.items()})
        asked = np.unique(np.concatenate(found), axis=0)
        first = np.flatnonzero(np.concatenate(([True], (asked[1:, :2] != asked[:-1, :2]).any(1)))) if len(asked) else np.empty(0, np.int64)
        lists = [x.tolist() for x in np.split(asked[:, 2], first[1:])] if len(asked) else []
        return pd.DataFrame({"a": asked[first, 0], "block": asked[first, 1], "others": pd.Series(lists, dtype=object)})

    return run


def _overlaps(s: np.ndarray, others: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the intersections of a sorted set with others that aren't empty, and the others' sizes."""
    length = np.array([len(x) for x in others])
    at = np.minimum(np.searchsorted(s, flat := np.concatenate(others)), len(s) - 1)
    return np.add.reduceat((s[at] == flat).astype(np.int64), np.cumsum(length) - length), length


def _confirm_lists(size: int, percent: int):
    """Documents with lists of others against the blocks that hold those, to the links that hold on full sets."""

    def run(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        sets, links = {}, []
        for block, turn, i, text in held[["h_block", "h_turn", "id", "text"]].itertuples(index=False):
            sets[block, turn, i] = shingle_set(text, size)
        for a, block, turn, others, text in asking[["a", "block", "turn", "others", "text"]].itertuples(index=False):
            s = shingle_set(text, size)
            found = [(b, x) for b in others if (x := sets.get((block, turn, b))) is not None and len(x)]
            if len(s) and found:
                both, length = _overlaps(s, [x for _, x in found])
                links += [(int(a), int(found[j][0])) for j in np.flatnonzero(100 * both >= percent * (len(s) + length - both))]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


class _Joined:
    """Which components links have joined by now."""

    def __init__(self, component: np.ndarray):
        self.of = np.unique(component, return_inverse=True)[1]

    def join(self, i: int, j: int) -> bool:
        a, b = self.of[i], self.of[j]
        if a != b:
            self.of[self.of == max(a, b)] = min(a, b)
        return bool(a != b)


def _within(size: int, percent: int):
    """Chunk pairs of homes to the links that join components; the documents of the smaller chunk side ask, one after the other."""

    def pairs(df: pd.DataFrame) -> list[tuple[int, int]]:
        ids, side, n, sig = df["id"].to_numpy(), df["part"].to_numpy(), df["n_shingles"].to_numpy(), np.stack(df["sig"].to_list())
        texts, sets, links, joined = df["text"].tolist(), {}, [], _Joined(df["component"].to_numpy())
        alone = side.min() == side.max()

        def held(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingle_set(texts[i], size)
            return sets[i]

        # Documents of small components first: they have the most to ask, and links that they find save others' asking.
        many = np.bincount(joined.of)[joined.of]
        for i in np.lexsort((ids, many)).tolist():
            later = (many > many[i]) | ((many == many[i]) & (ids > ids[i]))
            ok = later & (joined.of != joined.of[i]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i]))
            if not alone:
                ok &= side != side[i]
            ok = np.flatnonzero(ok)
            ok = ok[(sig[ok] == sig[i]).sum(1) >= SURE]
            while len(ok):
                now, ok = ok[:CHUNK], ok[CHUNK:]
                both, length = _overlaps(held(i), [held(j) for j in now.tolist()])
                for j in now[100 * both >= percent * (len(held(i)) + length - both)].tolist():
                    if joined.join(i, j):
                        links.append((int(ids[i]), int(ids[j])))
                ok = ok[joined.of[ok] != joined.of[i]]
        return links

    def run(df: pd.DataFrame) -> pd.DataFrame:
        links = [x for _, one in df.groupby(["home", "i", "j"], sort=True) for x in pairs(one)]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def _confirm(size: int):
    """Documents of many (centre, part), the centre's own and those paired with it, to each pair's similarity on full sets."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        rows, sets = [], {}
        for a, part, text in df.loc[df["is_centre"], ["a", "part", "text"]].itertuples(index=False):
            sets.setdefault((a, part), []).append(shingle_set(text, size))
        for a, part, b, text in df.loc[~df["is_centre"], ["a", "part", "id", "text"]].itertuples(index=False):
            s = shingle_set(text, size)
            for c in sets.get((a, part), ()):
                both = len(np.intersect1d(c, s, assume_unique=True))
                rows.append((a, b, both, len(c) + len(s) - both))
        return pd.DataFrame(rows, columns=["a", "b", "both", "either"], dtype="int64")

    return run


def compared(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(a, b, both, either) of the pairs (a, b) of ids: the sizes of their full shingle sets' intersection and union; texts: id, text.

    A document that is paired with very many is dealt out over parts, CHUNK of its partners to each on average, and parts over
    calls of Python, TEXTS to each. Pairs grow with the corpus, so nothing here is broadcast.
    """
    slots = max(1, -(-pairs.count() // TEXTS))
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("parts"))
    others = pairs.join(degree.hint("merge"), "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("id"), F.lit(False).alias("is_centre"))
    centres = degree.select("a", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), F.col("a").alias("id"), F.lit(True).alias("is_centre"))
    rows = others.union(centres).join(texts.hint("merge"), "id")
    slot = F.pmod(F.xxhash64("a", "part"), F.lit(slots)).cast("int").alias("slot")
    return rows.select(slot, "a", "part", "id", "is_centre", "text").groupBy("slot").applyInPandas(_confirm(size), "a long, b long, both long, either long")


def _links(compared_pairs: DataFrame, percent: int) -> DataFrame:
    return compared_pairs.where(100 * F.col("both") >= percent * F.col("either")).select("a", "b")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, for every row of docs (doc_id, text).

    Two documents are linked when 100 * |both| >= percent * |either| over their sets of `shingle_words`-word shingles;
    component_id is the smallest doc_id that links lead to. Fewer words than a shingle make one shingle of them all.
    Null, empty or blank text has no shingles and no links. Rows that share a doc_id are one document, linked through any
    of their texts; a row with a null doc_id isn't kept, and no component is named after it. Copies count as linked. Other columns
    aren't read. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    short_plans(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = staged(texts.mapInPandas(_describe(shingle_words), "doc_id long, n_shingles long, low long, high long, sig array<int>"), "shingles")
    classes = rows.where("n_shingles > 0").groupBy("low", "high").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
    classes = staged(classes.where("id is not null").select("id", "n_shingles", "sig", "low", "high"), "classes")
    reps = classes.select("id", "n_shingles", "sig")

    keyed = _keyed(classes)
    centres = staged(keyed.groupBy("bucket").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n"), "buckets")
    members = staged(keyed.join(centres, "bucket").select("bucket", "a", "id"), "members")
    l, r = reps.alias("l"), reps.alias("r")

    def possible(pairs: DataFrame) -> DataFrame:
        p = pairs.alias("p").join(l, F.col("p.a") == F.col("l.id")).join(r, F.col("p.b") == F.col("r.id"))
        fits = 100 * F.least("l.n_shingles", "r.n_shingles") >= percent * F.greatest("l.n_shingles", "r.n_shingles")
        return p.where(fits).where(_agree("l.sig", "r.sig") >= SURE).select("p.a", "p.b")

    checked = staged(possible(members.where("a < id").select("a", F.col("id").alias("b")).distinct()), "stars")
    candidates = _class_texts(texts, members.select("id"))
    near = staged(compared(checked, candidates, shingle_words), "near")
    links = _links(near, percent)
    labels = connected_components(links)

    # Homes that hold several components: all pairs across these, chunk against chunk.
    met = near.groupBy(F.col("b").alias("id")).agg(F.min(F.when(2 * F.col("both") >= F.col("either"), F.col("a"))).alias("home"), F.min("a").alias("first"))
    centre = members.groupBy("id").agg(F.min("a").alias("centre"))
    homes = centre.join(met, "id", "left").select("id", F.coalesce("home", "id").alias("home"), F.coalesce("first", "centre").alias("first"))
    homed = staged(homes.join(labels, "id", "left").select("id", "home", "first", F.coalesce("component", "id").alias("component")), "homed")
    homes = homed.join(reps, "id")
    counts = homes.groupBy("home").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    parts = F.greatest(F.ceil(F.col("n") / WIDE), F.ceil(F.col("m") / HEAVY)).cast("int").alias("parts")
    counts = counts.where("n > 1").select("home", parts, (F.col("lo") < F.col("hi")).alias("mixed"))
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.coalesce("parts", F.lit(1))).cast("int").alias("part")
    homes = staged(homes.join(counts, "home", "left").select("id", "home", "first", "component", "n_shingles", "sig", part, F.coalesce("parts", F.lit(1)).alias("parts"), F.coalesce("mixed", F.lit(False)).alias("mixed")), "homes")
    mixed = homes.where("mixed")
    slots = max(1, -(-int(mixed.agg(F.sum(F.col("n_shingles") * F.col("parts"))).first()[0] or 0) // SHINGLES))
    units = mixed.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))).withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
    slot = F.pmod(F.xxhash64("home", "i", "j"), F.lit(slots)).cast("int").alias("slot")
    units = units.join(candidates.hint("merge"), "id").select(slot, "home", "i", "j", "part", "id", "component", "n_shingles", "sig", "text")
    found = staged(units.groupBy("slot").applyInPandas(_within(shingle_words, percent), "a long, b long"), "within")
    links = links.union(found)
    labels = connected_components(links)

    # Buckets that hold several components of several homes: the pairs across homes, chunk against chunk.
    # A document's first centre is the smallest it was compared with, or else of its buckets. That one's own first centre names its blocks:
    # even where few members of a family are half similar, it has few blocks.
    region = homes.join(homes.select(F.col("id").alias("first"), F.col("first").alias("region")), "first").select("id", "home", "region", "n_shingles")
    room = region.groupBy("region").agg(F.greatest(F.ceil(F.count("*") / WIDE), F.ceil(F.sum("n_shingles") / HEAVY)).alias("rooms"))
    place = region.join(room, "region").select("id", "home", F.xxhash64("region", F.pmod(F.xxhash64("id", F.lit(2)), F.col("rooms"))).alias("block"))
    sizes = labels.groupBy("component").agg(F.count("*").alias("csize"))
    known = labels.join(sizes, "component")
    place = staged(place.join(known, "id", "left").select("id", "home", "block", F.coalesce("component", "id").alias("component"), F.coalesce("csize", F.lit(1)).alias("csize")), "place")
    named = members.join(place, "id")
    mixed = named.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("home").alias("from"), F.max("home").alias("to"), F.count("*").alias("n"))
    mixed = staged(mixed.where("lo < hi and from < to").select("bucket", F.ceil(F.col("n") / WIDE).cast("int").alias("parts")), "mixed")
    known = near.groupBy("a", F.col("b").alias("id")).agg(F.max(F.col("both") / F.col("either")).alias("to_centre"))
    rest = named.join(mixed, "bucket").join(known, ["a", "id"], "left").join(reps, "id")
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int").alias("part")
    to_centre = F.when(F.col("a") == F.col("id"), 1.0).otherwise(F.col("to_centre")).alias("to_centre")
    rest = staged(rest.select("bucket", "parts", part, "id", "component", "csize", "home", "block", to_centre, "n_shingles", "sig"), "rest")
    slots = max(1, -(-rest.count() // ROWS))
    slot = F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(slots)).cast("int").alias("slot")
    left = rest.withColumn("i", F.col("part")).withColumn("j", F.explode(F.expr("sequence(part, parts - 1)"))).select(slot, "i", "j", *FIELDS)
    right = rest.withColumn("j", F.col("part")).withColumn("i", F.explode(F.expr("sequence(0, part)"))).select(slot, "i", "j", *FIELDS)
    left, right = left.toDF(*[f"l_{c}" for c in left.columns]), right.toDF(*[f"r_{c}" for c in right.columns])
    asking = left.groupBy("l_slot").cogroup(right.groupBy("r_slot")).applyInPandas(_across(percent), "a long, block long, others array<long>")
    asking = asking_lists = staged(asking.groupBy("a", "block").agg(F.flatten(F.collect_list("others")).alias("others")), "asking")
    # The askers of a block in turns of about PAIRS pairs; each turn gets the block's documents that its askers name.
    turns = asking.groupBy("block").agg(F.ceil(F.sum(F.size("others")) / PAIRS).cast("int").alias("turns"))
    asking = asked = staged(asking.join(turns, "block").select("a", "block", "others", F.pmod(F.xxhash64("a"), F.col("turns")).cast("int").alias("turn")), "asked")
    held = asking.groupBy("block", "turn").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("ids")).select("block", "turn", F.explode("ids").alias("id"))
    slots = max(1, -(-(turns.agg(F.sum("turns")).first()[0] or 0) // 4))
    slot = F.pmod(F.xxhash64("block", "turn"), F.lit(slots)).cast("int")
    held = held.join(candidates.hint("merge"), "id").select(slot, "block", "turn", "id", "text").toDF("h_slot", "h_block", "h_turn", "id", "text")
    asking = asking.join(candidates.toDF("a", "text").hint("merge"), "a").select(slot.alias("slot"), "a", "block", "turn", "others", "text")
    across = staged(asking.groupBy("slot").cogroup(held.groupBy("h_slot")).applyInPandas(_confirm_lists(shingle_words, percent), "a long, b long"), "across")

    # A doc_id with several texts ties their classes together.
    named = rows.join(classes.select("low", "high", "id"), ["low", "high"], "left").select("doc_id", "n_shingles", F.coalesce("id", "doc_id").alias("id"))
    named = staged(named, "named")
    ties = named.where("doc_id is not null").groupBy("doc_id").agg(F.min("id").alias("a"), F.collect_set("id").alias("ids")).where("size(ids) > 1").select("a", F.explode("ids").alias("b"))
    labels = connected_components(links.union(across).union(ties))
    discard(rows, classes, candidates, centres, members, checked, near, homed, homes, found, place, mixed, rest, asking_lists, asked, across)
    component = F.coalesce("component", "id")
    out = named.join(labels, "id", "left")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _class_texts(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """id, text of the documents that ids names; ids grow with the corpus, so they aren't broadcast."""
    texts = texts.toDF("id", "text")
    return staged(texts.join(ids.distinct().hint("merge"), "id", "left_semi"), "texts")


def drop_near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, by_row: bool = False) -> DataFrame:
    """docs without near copies: of each group the document with the smallest doc_id stays; columns as given.

    Documents without words stay. By doc_id, of rows that share one the row with the smallest text stays; rows with a null doc_id go.
    By row, every row is a document of its own, whatever its doc_id: of each group the row with the smallest doc_id stays, a null one being
    the last, and of several such rows the one whose text has the smallest hash.
    """
    if by_row:
        docs, columns = staged(docs.withColumn("_near_row", F.monotonically_increasing_id()), "numbered"), docs.columns
        groups = near_duplicates(docs.select(F.col("_near_row").alias("doc_id"), "text"), shingle_words, percent).select(F.col("doc_id").alias("_near_row"), F.col("component_id").alias("_near_group"))
        groups = staged(groups, "groups")
        # Texts themselves would be shuffled for ties that are rare.
        order = F.struct(F.col("doc_id").isNull(), "doc_id", "_near_text", "_near_row")
        kept = docs.select("_near_row", "doc_id", F.xxhash64("text").alias("_near_text")).join(groups, "_near_row").groupBy("_near_group").agg(F.min_by("_near_row", order).alias("_near_row")).select("_near_row")
        return docs.join(kept, "_near_row", "left_semi").select(*[docs[c] for c in columns])
    kept = near_duplicates(docs, shingle_words, percent).where("kept").select(F.col("doc_id").alias("_near_id")).distinct()
    first = F.row_number().over(Window.partitionBy("_near_id").orderBy("text"))
    out = docs.join(kept, docs["doc_id"] == kept["_near_id"]).withColumn("_near_turn", first).where("_near_turn = 1")
    return out.select(*[out[c] for c in docs.columns])
