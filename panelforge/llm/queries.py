"""Registered queries of the subpackage: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (bpe, clustering, fingerprints, licenses, maxent, ngram_join, packing, phrases, pii, sharding, token_counts, toxicity,
               vectors)
from .store import read_documents


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_documents(spark, sf_dir)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_documents(spark, sf_dir))


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(read_documents(spark, sf_dir, "embeddings"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_documents(spark, sf_dir), [1.0] * 16).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


HELD_OUT = "coalesce(pmod(crc32(cast(cast(doc_id as string) as binary)), 3) = 1, false)"


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    model = toxicity.fit(docs, read_documents(spark, sf_dir, "labels"), f"not {HELD_OUT}")
    return toxicity.score(docs, model).select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score",
                                              F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_documents(spark, sf_dir))
    count = [F.size(F.filter("base", pii.of_kind(i))).cast("bigint").alias(f"n_{k}") for i, k in enumerate(pii.KINDS[:4])]
    return found.select("doc_id", *count, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_documents(spark, sf_dir))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fingerprints
    d = f.fingerprint_documents(read_documents(spark, sf_dir))
    return d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    f.as_text(F.col("sketch")).alias("fingerprint"), f.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                    f.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                    f.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


TESTED = "coalesce(pmod(crc32(cast(cast(doc_id as string) as binary)), 10) = 0, false)"
ROUND = "coalesce(pmod(floor(crc32(cast(cast(doc_id as string) as binary)) / 10), 4), 0)"


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    model = maxent.fit(docs.where(f"not {TESTED}"), ROUND)
    return maxent.score(docs, model).select("doc_id", F.expr(TESTED).alias("held_out"), "n_tokens", "n_known",
                                            F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(read_documents(spark, sf_dir))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_documents(spark, sf_dir))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = licenses.verdict(licenses.scan(read_documents(spark, sf_dir)))
    starts = F.transform("places", lambda p: p["start"])
    return d.select("doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"),
                    F.array_max(starts).alias("last_word"), "base_labels", "labels", "score")


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, _ = clustering.centroid_clusters(read_documents(spark, sf_dir, "embeddings"))
    return d.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                    F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256).alias("centroid_sha256"))


QUERIES = {f.__name__: f for f in (op1_packing, op2_ngram_join, op3_embeddings, op4_sharding, op5_toxicity, op6_pii, op7_token_counts, op8_fingerprints, op9_lm_scoring, op10_bpe,
                                   op11_phrases, op12_licenses, op13_clusters)}


def _clusters_sql(k: int = clustering.K, rounds: int = clustering.ROUNDS, dim: int = clustering.DIM) -> str:
    """All rounds of the clustering, one after the other; squared distances as sums of exact products."""
    steps = [f"""kept as materialized (
  select row_number() over () as id, vec_id, list_transform(embedding, lambda x: floor({clustering.SCALE} * x::double)) as v from embeddings
  where len(embedding) = {dim} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), c0 as materialized (
  select row_number() over (order by sha256('{clustering.SEED}:' || vec_id) nulls last, v) - 1 as c, v from kept
  qualify row_number() over (order by sha256('{clustering.SEED}:' || vec_id) nulls last, v) <= {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} as materialized (
  select id, vec_id, kept.v, min({{'d': (list_inner_product(kept.v, kept.v) - 2 * list_inner_product(kept.v, b.v) + list_inner_product(b.v, b.v))::bigint,
                                 'c': b.c}}) as near from kept, c{r} b group by 1, 2, 3)""")
        if r < rounds:
            steps.append(f"""s{r} as (select near.c as c, unnest(v)::bigint as x, unnest(range(len(v))) as i from a{r}
), m{r} as (select c, i, sum(x)::hugeint as s, count(*)::hugeint as n from s{r} group by 1, 2
), f{r} as (select c, list(((s - ((s % n) + n) % n) // n)::double order by i) as v from m{r} group by 1
), c{r + 1} as materialized (select b.c, coalesce(f{r}.v, b.v) as v from c{r} b left join f{r} on f{r}.c = b.c)""")
    return "with " + ", ".join(steps) + f"""
select vec_id, near.c::integer as cluster, near.d as distance, (sum(near.d) over (partition by near.c))::bigint as cluster_inertia,
       (sum(near.d) over ())::bigint as inertia, sha256(array_to_string(list_transform(b.v, lambda x: x::bigint), ',')) as centroid_sha256
from a{rounds} join c{rounds} b on b.c = near.c"""


SQL: dict[str, str] = {
    "op2_ngram_join": """
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words from documents
), s as materialized (
  select doc_id, case when len(words) = 0 then []
                      when len(words) < 5 then [array_to_string(words, ' ')]
                      else list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) end as shingles from w
), n as (select doc_id, len(shingles)::bigint as n_shingles from s),
each as materialized (select doc_id, unnest(shingles) as shingle from s),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as both_have from each a join each b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2),
pairs as (select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b
          where 100 * both_have >= 75 * (x.n_shingles + y.n_shingles - both_have)),
links as (select a, b from pairs union select b, a from pairs),
reach(a, b) as (select doc_id, doc_id from documents union select r.a, l.b from reach r join links l on r.b = l.a)
select n.doc_id, n_shingles, min(reach.b) as component_id from n join reach on reach.a = n.doc_id group by 1, 2""",
    "op3_embeddings": """
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings
), ok as (
  select * from v where label is not null and e is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(e, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from ok a join ok b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.98
), reach(a, b) as (
  select vec_id, vec_id from v union select r.a, l.b from reach r join links l on r.b = l.a
), low as (select a as vec_id, min(b) as component_id from reach group by a),
n as (select a as vec_id, count(*) as n_links from links group by a)
select low.vec_id, coalesce(n.n_links, 0)::bigint as n_links, component_id, component_id = low.vec_id as kept
from low left join n on n.vec_id = low.vec_id""",
    "op11_phrases": """
with d as (
  select row_number() over () as id, coalesce(lang, 'und') as lang,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') as pieces
  from documents
), p as (select id, lang, unnest(pieces) as piece, unnest(range(len(pieces))) as k from d
), q as (select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') as w from p
), one as (select lang, unnest(w) as x from q
), f1 as materialized (select lang, x, count(*) as f from one group by 1, 2
), n as (select lang, sum(f)::bigint as n from f1 group by 1
), two as (select lang, unnest(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) as x from q
), f2 as materialized (select lang, x, count(*) as f from two group by 1, 2 having count(*) >= 10
), three as (select lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) as x from q
), f3 as materialized (select lang, x, count(*) as f from three group by 1, 2 having count(*) >= 10
), pair as (
  select c.lang, c.x, c.f as a, l.f as l, r.f as r, (1000000::hugeint * c.f * c.f) // (l.f::hugeint * r.f) as score
  from f2 c join f1 l on l.lang = c.lang and l.x = c.x[1] join f1 r on r.lang = c.lang and r.x = c.x[2]
  where not exists (select 1 from f3 t where t.lang = c.lang and (t.x[1:2] = c.x or t.x[2:3] = c.x) and 100 * t.f >= 50 * c.f)
), cuts as (
  select c.lang, c.x, c.f as a, l.f as l, r.f as r, (1000000::hugeint * c.f * c.f) // (l.f::hugeint * r.f) as score, 1 as k
  from f3 c join f1 l on l.lang = c.lang and l.x = c.x[1] join f2 r on r.lang = c.lang and r.x = c.x[2:3]
  union all
  select c.lang, c.x, c.f, l.f, r.f, (1000000::hugeint * c.f * c.f) // (l.f::hugeint * r.f), 2
  from f3 c join f2 l on l.lang = c.lang and l.x = c.x[1:2] join f1 r on r.lang = c.lang and r.x = c.x[3]
), triple as (select lang, x, a, l, r, score from cuts qualify row_number() over (partition by lang, x order by score, k) = 1
), found as (select lang, array_to_string(x, ' ') as phrase, a, l, r, score from pair union all select lang, array_to_string(x, ' '), a, l, r, score from triple
), ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from found)
select ranked.lang, rank, phrase, a, l, r, n.n, score::bigint as score from ranked join n on n.lang = ranked.lang where rank <= 2000""",
    "op13_clusters": _clusters_sql(),
}
