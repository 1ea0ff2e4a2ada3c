"""The queries of this subpackage's operators, each over the whole of its table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import bpe, cluster, fingerprint, htmltext, langid, mixing, neardup, recompress, tokenfile, topk, toxicity, warc, whiten
from framelake.llm.common import remainder, table

#: The end id that op6 appends.
END_ID = 2


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_ball_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op2_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.clusters(table(spark, sf_dir, "documents"), percent=85)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extracted(table(spark, sf_dir, "pages"))


def op4_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op5_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), vocabulary())


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.read(spark, tokenfile.write(table(spark, sf_dir, "documents"), vocabulary(), END_ID))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    return toxicity.scored(docs, model).select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = recompress.deduped(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_shard")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dicts = langid.dictionaries(docs, remainder("doc_id", 3) != 1)
    return langid.predict(docs, dicts).select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op11_gemm_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.clusters(table(spark, sf_dir, "embeddings"))


def op12_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.read(spark, warc.write(table(spark, sf_dir, "pages")), with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_tsqr_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whitened(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_ball_tree_topk, op2_minhash_neardup, op3_html_text, op4_iblt_fingerprints, op5_bpe_tree, op6_token_files, op7_toxicity, op8_substring_dedup, op9_source_mix, op10_language_id, op11_gemm_clusters, op12_warc_records, op13_tsqr_whitening]
    import corpus_pipeline

    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def _rounds(k: int, rounds: int, dims: int, scale: int, seed: int) -> str:
    """k-means in SQL: a table of centroids for each round."""
    lists = lambda x, y: f"list_sum(list_transform(list_zip({x}, {y}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    near = lambda r: f"n{r} as (select vec_id, x, arg_min(j, (d, j)) as j, min(d) as d from (select v.vec_id, v.x, c.j, {lists('v.x', 'c.x')} as d from v, c{r} c) group by vec_id, x)"
    step = lambda r: f"""{near(r - 1)},
m{r} as (select j, i, sum(x[i])::hugeint as s, count(*)::hugeint as n from n{r - 1}, unnest(range(1, {dims + 1})) as t(i) group by j, i),
g{r} as (select j, list((s - ((s % n) + n) % n) // n order by i) as x from m{r} group by j),
c{r} as (select c.j, coalesce(g.x, c.x) as x from c{r - 1} c left join g{r} g using (j))"""  # noqa: E731
    steps = ",\n".join(step(r) for r in range(1, rounds + 1))
    return f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::hugeint) as x from embeddings
  where len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), h as (select x, row_number() over (order by sha256('{seed}:' || vec_id), x) - 1 as j from v),
c0 as (select j, x from h where j < {k}),
{steps},
{near(rounds)},
z as (select j, sum(d)::bigint as s from n{rounds} group by j)
select vec_id, n.j::integer as cluster, d::bigint as distance, z.s as cluster_inertia, (select sum(s)::bigint from z) as inertia,
  sha256(array_to_string(c.x, ',')) as centroid_sha256
from n{rounds} n join z using (j) join c{rounds} c using (j)"""


_WORD = r"[^\x20\x09-\x0D]+"

ORACLES = {
    "op1_ball_tree_topk": """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::integer as rank, vec_id, score from r where rank <= 5""",
    "op2_minhash_neardup": f"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as w from documents
), s as (
  select distinct doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') as g
  from w, unnest(range(1, len(w) - least(5, len(w)) + 2)) as t(i) where len(w) > 0
), n as (select doc_id, count(*) as n from s group by doc_id),
l as (
  select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.g = y.g and x.doc_id <> y.doc_id group by all) p
  join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 85 * (na.n + nb.n - c)
), c as (
  select doc_id as node, doc_id as reach from documents
  union
  select c.node, l.b from c join l on c.reach = l.a
), m as (select node, min(reach) as component_id from c group by node)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, m.component_id, d.doc_id = m.component_id as kept,
  (select min(e.doc_id) from w e where n.n is not null and e.w = ww.w) as class_id
from documents d join m on m.node = d.doc_id join w ww on ww.doc_id = d.doc_id left join n on n.doc_id = d.doc_id""",
    "op8_substring_dedup": f"""
with w as (select doc_id, coalesce(regexp_extract_all(text, '{_WORD}'), []) as w from documents),
g as (select doc_id, i, array_to_string(w[i : i + 19], ' ') as g from w, unnest(range(1, greatest(len(w) - 18, 1))) as t(i)),
f as (select doc_id, i, row_number() over (partition by g order by doc_id, i) as rn from g),
c as (select distinct doc_id, i + o as j from f, unnest(range(0, 20)) as t(o) where rn > 1),
k as (
  select w.doc_id, t.j, w.w[t.j] as word, c.j is not null as gone
  from w, unnest(range(1, len(w.w) + 1)) as t(j) left join c on c.doc_id = w.doc_id and c.j = t.j
), r as (
  select doc_id, count(*) filter (where gone) as n_removed, coalesce(string_agg(word, ' ' order by j) filter (where not gone), '') as kept from k group by doc_id
)
select w.doc_id, len(w.w)::bigint as n_words, coalesce(r.n_removed, 0)::bigint as n_removed, sha256(coalesce(r.kept, '')) as kept_sha256
from w left join r on r.doc_id = w.doc_id""",
    "op11_gemm_clusters": _rounds(16, 3, 64, 64, 1),
    "op12_warc_records": """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha256(coalesce(html, '')) as d from pages),
f as (select *, case when n >= 100 then min(page_id) over (partition by d) end as first from p)
select page_id, n::bigint as payload_bytes, d as payload_digest, case when page_id > first then 'revisit' else 'response' end as record_type,
  case when page_id > first then first end as refers_to from f""",
}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    return dict(ORACLES) | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
