"""The queries of this folder, by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, crf, ctw, minhash, mixing, mpeg, negatives, packing, phrases, pii, topk, viterbi, winnow
from .common import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix of all sources takes each document."""
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """Where the vocabulary file of the packing query is; a public file that the environment supplies."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces and their places in sequences of 4,096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2, window=4096, with_ids=False)


def op3_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans by rules, all spans by trees."""
    return pii.report(table(spark, sf_dir, "documents"))


def op4_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the view of each participant."""
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest scores of the rows whose vec_id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5).withColumnRenamed("id", "vec_id")


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share 80 percent of their two-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


def op7_context_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by a byte model and by word frequencies of the training documents."""
    return ctw.score_texts(table(spark, sf_dir, "documents"), folds=7, held_fold=2)


def op8_viterbi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under a unigram vocabulary."""
    import public_tokenizers

    return viterbi.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), in_bytes=True)


def op9_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as an audio stream, read back and described."""
    found = mpeg.read_media(mpeg.encode_texts(table(spark, sf_dir, "documents")))
    offsets = F.concat_ws(",", F.transform("seek_offsets", lambda x: x.cast("string"))).alias("seek_offsets")
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "frames", "seconds", "crc_ok", "crc_bad", offsets)


def op10_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by a model of the other four folds."""
    return crf.identify(table(spark, sf_dir, "documents"), folds=5, held_fold=0)


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and their likenesses."""
    return winnow.edit_report(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of every language of the documents."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by 100, with every seventh vec_id's label moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_retrieval_packing": op2_retrieval_packing,
    "op3_pii_boosting": op3_pii_boosting,
    "op4_chat_rotation": op4_chat_rotation,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_context_tree_lm": op7_context_tree_lm,
    "op8_viterbi_counts": op8_viterbi_counts,
    "op9_mpeg_audio": op9_mpeg_audio,
    "op10_crf_language_id": op10_crf_language_id,
    "op11_winnowing": op11_winnowing,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {
    "op4_chat_rotation": r"""
with t as (select conv_id, turn, coalesce(role, 'unknown') speaker, coalesce(text, '') text from conversations where conv_id is not null),
p as (select distinct conv_id, speaker perspective from t where speaker <> 'system'),
r as (select t.*, perspective, case when speaker = 'system' then 'system' when speaker = perspective then 'assistant' else 'user' end role from t join p using (conv_id)),
m as (select *, concat('<', role, case when role = 'user' then concat(':', speaker) else '' end, '>', chr(10), text, chr(10), '</>', chr(10)) message from r),
s as (select *, cast(coalesce(sum(length(message)) over (partition by conv_id, perspective order by turn nulls last, speaker, text rows between unbounded preceding and 1 preceding), 0) as bigint) start from m)
select conv_id, perspective, turn, role, case when role = 'user' then speaker end as name, message, start,
  case when role = 'assistant' then start + length(message) - length(text) - 5 end train_start, case when role = 'assistant' then start + length(message) end train_end from s
""",
    "op5_exact_top_k": """
with v as (select cast(vec_id as bigint) id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) e, row_number() over () r from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.r, q.id query_id, c.id vec_id, c.r other, cast(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) as bigint) score
  from v q join v c on q.r <> c.r and len(q.e) = len(c.e) where q.id % 50 = 0)
select query_id, cast(row_number() over (partition by r order by score desc, vec_id, other) as integer) rank, vec_id, score from s
qualify row_number() over (partition by r order by score desc, vec_id, other) <= 5
""",
    "op12_collocations": r"""
with d as (select coalesce(lang, 'und') lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t, row_number() over () doc from documents),
p as (select lang, doc, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) piece, generate_subscripts(string_split_regex(t, '[.,;:!?\x0A-\x0D]'), 1) no from d),
w as (select lang, doc, no, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') ws from p),
t as (select lang, sum(len(ws))::bigint n from w group by 1),
g as (select lang, m, ws[i : i + m - 1] ph from (select lang, ws, m, unnest(range(1, len(ws) - m + 2)) i from w, (values (1), (2), (3), (4), (5)) z(m) where len(ws) >= m)),
f as (select lang, m, ph, count(*) f from g group by all having count(*) >= 100),
c as (select a.lang, a.ph, a.m, a.f a, l.f l, r.f r, n, k, (1000::hugeint * a.f * n) // (l.f::hugeint * r.f) score
  from (select *, unnest(range(1, m)) k from f where m > 1) a join t on t.lang = a.lang join f l on l.lang = a.lang and l.ph = a.ph[1 : k] join f r on r.lang = a.lang and r.ph = a.ph[k + 1 : a.m]),
b as (select * from c qualify row_number() over (partition by lang, ph order by score, k) = 1),
x as (select lang, ph[i : i + s - 1] ph, max(f) f from (select lang, f, ph, s, unnest(range(1, m - s + 2)) i from f, (values (2), (3), (4)) z(s) where s < m) group by 1, 2),
o as (select b.*, array_to_string(b.ph, ' ') phrase from b left join x on x.lang = b.lang and x.ph = b.ph where x.f is null or x.f < b.a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a::bigint a, l::bigint l, r::bigint r, n, score::bigint score from o
qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= 2000
""",
    "op13_hard_negatives": """
with v as (select cast(vec_id as bigint) id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) e, row_number() over () r from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.r qr, q.id anchor_id, c.r cr, c.id, q.label = c.label same, cast(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) as bigint) score
  from v q join v c on q.r <> c.r and len(q.e) = len(c.e) where q.id % 100 = 0),
p as (select qr, anchor_id, id positive_id, score positive_score, row_number() over (partition by qr order by score desc, id, cr) k from s where same qualify k <= 5)
select p.anchor_id, positive_id, cast(row_number() over (partition by p.qr, k order by score desc, id, cr) as integer) rank, id negative_id, positive_score, score negative_score
from p join s on p.qr = s.qr and not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by p.qr, k order by score desc, id, cr) <= 10
""",
    "op1_mix_sources": r"""
with d as (select doc_id, coalesce(source, '') src, source is null src_null, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) size,
  cast(('0x' || substr(md5(concat_ws('|', cast(doc_id as varchar), '17')), 1, 15)) as bigint) h from documents),
t as (select src, src_null, cast(sum(size) as bigint) source_size from d group by all),
w as (select *, [5.0, 2.0, 1.0][(row_number() over (order by src_null, src) - 1) % 3 + 1]::double weight, source_size * 3.0::double cap, sum(source_size) over () * 1.0::double budget from t),
v as (select *, cap / weight lev from w),
u as (select *, sum(cap) over o caps, sum(weight) over () - sum(weight) over o rest from v window o as (order by lev, src_null, src rows unbounded preceding)),
c as (select *, caps + lev * rest <= budget clamped from u),
g as (select src, src_null, source_size, case when clamped then cap else (budget - coalesce(sum(case when clamped then cap end) over (), 0)) / sum(case when not clamped then weight end) over () * weight end target from c),
p as (select *, cast(coalesce(case when target >= source_size * 3.0 then 3 else floor(target / nullif(source_size, 0)) end, 0) as bigint) whole from g),
r as (select d.*, p.* exclude (src, src_null), greatest(0, target - whole * source_size) frac, coalesce(sum(size) over (partition by d.src, d.src_null order by h // 1 % 4096, h, doc_id, size rows between unbounded preceding and 1 preceding), 0) before
  from d join p on d.src = p.src and d.src_null = p.src_null),
x as (select *, cast(whole + case when whole < 3 and before + size / 2 <= frac and frac > 0 then 1 else 0 end as bigint) copies from r)
select doc_id, size, source_size, cast(target as double) target, cast(copies * size as bigint) taken, copies from x
""",
}
