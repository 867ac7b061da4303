"""The pipeline's stages on a small corpus, against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_operators import DOCS, base_spans, brute_components, expected_targets, language_docs

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    made = language_docs(150)
    texts = [(i, t + (f" Mail me{i}@example.com or 10.0.0.{i}." if i % 4 == 0 else ""), lang, ("web", "wiki", None)[i % 3], len(t)) for i, t, lang, _, _ in made]
    texts += [(500 + i, texts[3][1], texts[3][2], "web", 1) for i in range(40)]
    texts += [(600, None, None, "web", None), (601, "", "en", "web", 0), (602, "123 !!", None, "wiki", 6)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(texts, DOCS).write.parquet(str(path / "documents.parquet"))
    return str(path), {t[0]: t for t in texts}


def test_stages(spark, corpus):
    path, by_id = corpus
    docs, columns = spark.read.parquet(f"{path}/documents.parquet"), None
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = columns or docs.columns
        docs = stage(spark, docs, path)
        docs.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        assert docs.columns == columns or name == "packing"
        seen[name] = docs.collect()
    kept = {r["doc_id"] for r in seen["language_id"]}
    assert kept == set(by_id) - {600, 601, 602}
    unique = {r["doc_id"] for r in seen["near_dedup"]}
    components = brute_components([(i, by_id[i][1]) for i in sorted(kept)], 5)
    assert unique == {i for i in kept if components[i] == i} and not unique & set(range(500, 540))
    for r in seen["pii"]:
        assert not base_spans(r["text"]) and r["n_chars"] == len(r["text"]) and ("<EMAIL>" in r["text"]) == (r["doc_id"] % 4 == 0)
    sizes, taken = Counter(), Counter()
    size_of = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in seen["pii"]}
    source_of = {r["doc_id"]: r["source"] for r in seen["pii"]}
    for i, n in size_of.items():
        sizes[source_of[i]] += n
    copies = Counter(r["doc_id"] for r in seen["mixing"])
    for i, n in copies.items():
        taken[source_of[i]] += n * size_of[i]
    want = expected_targets(sizes)
    assert max(copies.values()) <= 3 and all(abs(taken[s] - want[s]) <= max(n for i, n in size_of.items() if source_of[i] == s) for s in sizes)
    pieces = [r.asDict() for r in seen["packing"]]
    lengths = defaultdict(int)
    for p in pieces:
        lengths[p["doc_id"]] += p["length"]
        assert zlib.crc32(np.array(p["ids"], "<u4").tobytes()) == p["ids_crc32"]
    assert all(lengths[i] == copies[i] * next(p["doc_tokens"] for p in pieces if p["doc_id"] == i) for i in copies)


def test_run_applies_all_stages(spark, corpus):
    path, _ = corpus
    out = corpus_pipeline.run(spark, path)
    assert out.columns == spark.read.parquet(f"{path}/packing").columns
    assert out.groupBy("sequence_id").sum("length").where("sum(length) > 4096").count() == 0


def test_rows_without_an_id_and_with_a_shared_one_stay(spark):
    fox, sea, owl, elm = (" ".join(f"{w}{i}" for i in range(30)) for w in ("fox", "sea", "owl", "elm"))
    made = [(None, fox), (None, fox), (None, sea), (5, sea), (7, owl), (7, elm), (8, owl)]
    df = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in made], DOCS)
    kept = corpus_pipeline.near_dedup(spark, df, "")
    assert kept.columns == df.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter([(None, fox), (5, sea), (7, owl), (7, elm)])
    mixed = corpus_pipeline.mix_sources(spark, kept, "")
    assert mixed.columns == df.columns
    assert Counter((r["doc_id"], r["text"]) for r in mixed.collect()) == Counter([(None, fox), (5, sea), (7, owl), (7, elm)])
