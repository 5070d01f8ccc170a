"""The registered queries of this subpackage: one per operator, each over its
whole table, with DuckDB SQL for those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, fuzzyhash, gbdt, hmm, html_text, mixing, ngramjoin, packing, pcadedup, phrases, spelling,
    toxicity, warc,
)
from .common import fold, shared_path, table

TOKENIZER = "byte_bpe_50k.json"
QUALITY_CUT = 0.3
TOXIC_CUT = 0.5


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    return bpe.encode(docs, path, decoded=True).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.extract(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op3_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def op4_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = gbdt.fit(docs, table(spark, sf_dir, "labels"))
    return _scored(docs, gbdt.score_column(F.col("text"), trees), QUALITY_CUT)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    records = warc.read_archive(spark, path, with_payload=False)
    return capture_digests(warc.assemble(records))


def capture_digests(captures: DataFrame) -> DataFrame:
    """A row per page; a revisit's response is found by the record it refers to."""
    page_id = F.regexp_extract(F.col("metadata")[0]["fields"], r"page_id: (-?\d+)", 1)
    rows = captures.select(
        "record_id",
        F.when(page_id != "", page_id).cast("long").alias("page_id"),
        F.col("answer.payload_bytes").alias("payload_bytes"),
        F.col("answer.payload_digest").alias("payload_digest"),
        F.col("answer.type").alias("record_type"),
        F.col("answer.refers_to").alias("first_id"),
    )
    firsts = rows.filter(F.col("record_type") == "response").select(
        F.col("record_id").alias("first_id"), F.col("page_id").alias("refers_to")
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    # responses refer to nothing: only revisits are joined
    refers = F.col("first_id").isNotNull()
    return rows.filter(refers).join(firsts, "first_id", "left").select(*columns).unionByName(
        rows.filter(~refers).withColumn("refers_to", F.lit(None).cast("long")).select(*columns)
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _scored(docs, toxicity.score_column(F.col("text"), model), TOXIC_CUT)


def _scored(docs: DataFrame, score, cut: float) -> DataFrame:
    return docs.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= cut).cast("int"))


def op7_fuzzy_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzyhash.compare_following(table(spark, sf_dir, "documents"))


def op8_pca_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pcadedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def op10_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.link(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id"
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_bpe, op2_html_text, op3_hidden_markov, op4_quality_trees, op5_warc, op6_toxicity,
        op7_fuzzy_hash, op8_pca_dedup, op9_mix_sources, op10_shingle_join, op11_packing,
        op12_phrases, op13_spelling,
    )
    return {f.__name__: f for f in found}


_WORDS = r"'[^\x20\x09-\x0D]+'"

_OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS x FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first_id FROM h)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT)
      >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT) + 1, 1)), 'string_agg', '')
    AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

_OP8 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL
    OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach
  JOIN link ON reach.b = link.a)
SELECT e.vec_id,
  (SELECT count(*) FROM link WHERE a = e.vec_id) AS n_links,
  least(e.vec_id, coalesce((SELECT min(b) FROM reach WHERE a = e.vec_id), e.vec_id))
    AS component_id,
  e.vec_id = least(e.vec_id, coalesce((SELECT min(b) FROM reach WHERE a = e.vec_id), e.vec_id))
    AS kept
FROM embeddings e
"""

_OP9 = f"""
WITH d AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, {_WORDS})), 0)::BIGINT AS size,
    ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]
  AS weight FROM s),
o AS (SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight,
  coalesce(sum(source_size) OVER r, 0) AS size_before,
  coalesce(sum(weight) OVER r, 0) AS weight_before,
  row_number() OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS k
  FROM w WINDOW r AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, ((3 * total)::DOUBLE / 2 - (2 * size_before)::DOUBLE)
  / (all_weight - weight_before)::DOUBLE AS level FROM o),
c AS (SELECT level FROM l WHERE level * weight < 2 * source_size ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(coalesce((SELECT level FROM c) * weight,
  (2 * source_size)::DOUBLE), (2 * source_size)::DOUBLE) AS target FROM l),
n AS (SELECT d.*, source_size, target,
  (row_number() OVER (PARTITION BY d.source ORDER BY size, h % 256, h, doc_id))::DOUBLE AS r,
  CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
  ('0x' || substr(md5('mix#' || coalesce(d.source, chr(0) || 'null')), 1, 8))::BIGINT
    / 4294967296.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  ((floor(u + rate * r) - floor(u + rate * (r - 1.0::DOUBLE))) * size)::BIGINT AS taken
FROM n
"""

_OP10 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w,
    'string_agg', ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4],
    'string_agg', ' '))) END AS g FROM d),
n AS (SELECT doc_id, len(g)::BIGINT AS n FROM s),
x AS (SELECT doc_id, unnest(g) AS g FROM s),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM x a JOIN x b
  ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
half AS (SELECT a, b FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
link AS (SELECT a, b FROM half UNION SELECT b, a FROM half),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach
  JOIN link ON reach.b = link.a)
SELECT n.doc_id, n.n AS n_shingles,
  least(n.doc_id, coalesce((SELECT min(b) FROM reach WHERE a = n.doc_id), n.doc_id))
    AS component_id
FROM n
"""


_OP12 = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM p GROUP BY lang),
s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
g AS (SELECT lang, w[i:i + k - 1] AS w FROM s, range(1, 6) AS t(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, w, count(*)::HUGEINT AS f FROM g GROUP BY lang, w HAVING count(*) >= 100),
c AS (SELECT lang, w, f AS a FROM f WHERE len(w) >= 2),
cut AS (SELECT lang, w, a, unnest(range(1, len(w))) AS k FROM c),
scored AS (
  SELECT cut.lang, cut.w, a, k, x.f AS l, y.f AS r, n, 1000 * a * n // (x.f * y.f) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.w = cut.w[1:k]
    JOIN f y ON y.lang = cut.lang AND y.w = cut.w[k + 1:] JOIN total ON total.lang = cut.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = b.lang
  AND len(c.w) = len(b.w) + 1 AND c.a >= b.a AND (c.w[1:len(b.w)] = b.w OR c.w[2:] = b.w))),
phrases AS (SELECT *, list_aggregate(w, 'string_agg', ' ') AS phrase FROM kept)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM phrases
QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_warc": _OP5, "op8_pca_dedup": _OP8, "op9_mix_sources": _OP9,
        "op10_shingle_join": _OP10, "op12_phrases": _OP12,
    }
