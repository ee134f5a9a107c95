"""One query for each operator of this folder, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm import divergence, embeddings, fill_middle, fingerprints, language, line_dedup, minhash, mixing, packing, secrets, toxicity, warc
from tickflow.llm.bpe import Tokenizer
from tickflow.llm.common import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoded_digests(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """doc_id, the number and digest of its ids, and the digest of what the ids decode to."""
    ids = docs.select("doc_id", tokenizer.encode("text").alias("ids"))
    return ids.select("doc_id", "ids", tokenizer.decode("ids").alias("decoded")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op7_bpe(spark, sf_dir):
    return encoded_digests(_documents(spark, sf_dir), Tokenizer(spark, tokenizer_path()))


#: A score from here on predicts label 1.
TOXIC_FROM = 0.7


@query
def op10_toxicity(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity.toxicity(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


@query
def op9_line_dedup(spark, sf_dir):
    kept = line_dedup.dedup_lines(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_dropped", F.length("text").alias("n_chars_kept"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@query
def op3_minhash(spark, sf_dir):
    return minhash.near_duplicates(_documents(spark, sf_dir), shingle=3, percent=85)


@query
def op2_mixing(spark, sf_dir):
    mixed = mixing.mix(_documents(spark, sf_dir))
    return mixed.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query
def op5_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_documents(_documents(spark, sf_dir))


@query
def op6_secrets(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    found = docs.select("doc_id", secrets.scan(docs, secrets.train(docs)).alias("found")).select("doc_id", "found.*")
    count = lambda kind: F.regexp_count("base", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}")
    digest = F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), digest, "spans")


@query
def op8_language(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    net = language.train(docs)
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), language.language(docs, net).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


@query
def op1_embeddings(spark, sf_dir):
    return embeddings.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op4_warc(spark, sf_dir):
    entries = warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return entries.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op4_warc"] = f"""
with p as (select page_id, coalesce(html, '') as payload from pages),
q as (select page_id, octet_length(encode(payload)) as payload_bytes, sha1(payload) as payload_digest from p),
r as (select *, payload_bytes >= {warc.REVISIT_FROM} and page_id < max(page_id) over (partition by payload_digest) as again,
             max(page_id) over (partition by payload_digest) as original from q)
select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type,
       case when again then original end as refers_to
from r"""


@query
def op11_divergence(spark, sf_dir):
    return divergence.divergence(_documents(spark, sf_dir))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLES["op11_divergence"] = f"""
with d as (select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce("text", '') as text from documents),
w as (select row, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
k as (select lang, term, count(*) as total from w group by all having count(distinct row) >= 10),
c as (select lang, source, term, count(*) as n from w join k using (lang, term) group by all),
g as (select distinct lang, source from d),
l as (select lang, count(term) as v, coalesce(sum(total), 0) as n from (select distinct lang from g) left join k using (lang) group by lang),
s as (select g.lang, g.source, l.v, l.n as lang_n, (select coalesce(sum(c.n), 0) from c where c.lang = g.lang and c.source = g.source) as group_n from g join l using (lang)),
p as (select s.lang, s.source, k.term, coalesce(c.n, 0) as n,
        1 + 1000000000::hugeint * (coalesce(c.n, 0) + 2) // (s.group_n + 2 * s.v) as p,
        1 + 1000000000::hugeint * (k.total + 2) // (s.lang_n + 2 * s.v) as q
      from s join k using (lang) left join c on c.lang = s.lang and c.source = s.source and c.term = k.term),
f as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
      from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
r as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0) as value
      from g a join g b on a.lang = b.lang and a.source <> b.source
      left join f on f.lang = a.lang and f.source = a.source and f.item = b.source
      union all
      select lang, source, 'term', term, (p - q) * (p - q) // (p + q) from p where n > 0 and p > q),
o as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from r)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from o where part = 'pair' or rank <= 10"""


@query
def op12_packing(spark, sf_dir):
    return packing.pack(packing.pieces(_documents(spark, sf_dir), tokenizer_path()))


@query
def op13_fill_middle(spark, sf_dir):
    cut = fill_middle.fill_in_middle(_documents(spark, sf_dir))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"), digest(fill_middle.restored("output", "form")).alias("restored_sha256"),
    )


_H = ", ".join(f"('0x' || substr(h, {8 * i + 1}, 8))::bigint as h{i + 1}" for i in range(4))
ORACLES["op13_fill_middle"] = f"""
with d as (select doc_id, coalesce("text", '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
e as (select doc_id, t, length(t) as n, {_H} from d),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
             when h4 % 100 < 20 then 'spm' else 'psm' end as form from e),
o as (select *, substr(t, 1, a) as prefix, substr(t, a + 1, b - a) as middle, substr(t, b + 1) as suffix from c)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(t) as restored_sha256
from o"""
