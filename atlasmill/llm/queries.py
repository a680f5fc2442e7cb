"""The registered queries of this subpackage and, where SQL expresses them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from atlasmill.llm import fst_tokens, html_extract, langid, mixing, ngram_join, packing, quality, sharding, topk, urls
from atlasmill.llm.common import table


def tokenizer_file(name: str) -> str:
    """Where the installation keeps a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.url_filter(pages).select("page_id", "host", "path", "rule", "verdict")


def op3_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.minimax_shards(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fst_tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), keep=["doc_id"])


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_shard")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs), keep=["doc_id"])


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars", "n_repeated")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_quality_rules, op2_url_filter, op3_minimax_shards, op4_token_counts, op5_ngram_join, op6_exact_top_k, op7_source_mix, op8_language_id, op9_best_fit_packing, op10_main_text]
    return {f.__name__: f for f in found}


_BUCKET = "(({v}) >> greatest(length(bin({v})) - 8, 0)) << greatest(length(bin({v})) - 8, 0)"

OP1_SQL = f"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, count(*) AS n_lines, count(DISTINCT line) AS d FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1) GROUP BY doc_id),
c AS (SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(n_lines - d, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
  CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines FROM w LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, 1000 * n_symbols // greatest(n_words, 1) AS s, 1000 * word_chars // greatest(n_words, 1) AS m, 1000 * n_dup_lines // greatest(n_lines, 1) AS u FROM c),
v AS (SELECT *, CAST({_BUCKET.format(v="s")} AS BIGINT) AS bs, CAST({_BUCKET.format(v="m")} AS BIGINT) AS bm, CAST({_BUCKET.format(v="u")} AS BIGINT) AS bu FROM b),
k AS (SELECT lang, source, ratio, bucket, count(*) AS n FROM
  (SELECT lang, source, 's' AS ratio, bs AS bucket FROM v WHERE NOT base_failed UNION ALL SELECT lang, source, 'm', bm FROM v WHERE NOT base_failed UNION ALL SELECT lang, source, 'u', bu FROM v WHERE NOT base_failed) GROUP BY ALL),
kl AS (SELECT lang, ratio, bucket, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY ALL),
ka AS (SELECT ratio, bucket, CAST(16 * 65536 * n AS BIGINT) // CAST(sum(n) OVER (PARTITION BY ratio) AS BIGINT) AS w FROM (SELECT ratio, bucket, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY ALL)),
la AS (SELECT lang, ka.* FROM (SELECT DISTINCT lang, ratio FROM kl) l JOIN ka USING (ratio)),
lw AS (SELECT 1 AS kind, lang, NULL AS source, ratio, bucket, n * 65536 AS w FROM kl UNION ALL SELECT 1, lang, NULL, ratio, bucket, w FROM la),
sh AS (SELECT lang, ratio, bucket, CAST(64 * 65536 * n AS BIGINT) // CAST(sum(n) OVER (PARTITION BY lang, ratio) AS BIGINT) AS w FROM kl UNION ALL SELECT lang, ratio, bucket, w FROM la),
cw AS (SELECT 2 AS kind, lang, source, ratio, bucket, n * 65536 AS w FROM k UNION ALL SELECT 2, c.lang, c.source, c.ratio, bucket, w FROM (SELECT DISTINCT lang, source, ratio FROM k) c JOIN sh ON c.lang IS NOT DISTINCT FROM sh.lang AND c.ratio = sh.ratio),
h AS (SELECT kind, lang, source, ratio, bucket, sum(w) AS w FROM (SELECT * FROM lw UNION ALL SELECT * FROM cw) GROUP BY ALL),
r2 AS (SELECT *, CASE ratio WHEN 'u' THEN 1 ELSE 25 END AS o, CASE ratio WHEN 's' THEN 6 WHEN 'm' THEN 8 ELSE 2 END AS t, sum(w) OVER (PARTITION BY kind, lang, source, ratio ORDER BY bucket) AS x, sum(w) OVER (PARTITION BY kind, lang, source, ratio) AS a FROM h),
q AS (SELECT kind, lang, source, ratio, max(t) AS t, min(CASE WHEN x * 100 >= a * o THEN bucket END) AS un, min(CASE WHEN x * 100 >= a * 50 THEN bucket END) AS mid, min(CASE WHEN x * 100 >= a * (100 - o) THEN bucket END) AS ov FROM r2 GROUP BY kind, lang, source, ratio),
f AS (SELECT kind, lang, source, ratio, mid, un - t * (mid - un) AS low, ov + t * (ov - mid) AS high FROM q),
z AS (SELECT c.lang, c.source, max(CASE WHEN c.ratio = 's' THEN CASE WHEN c.mid <= l.high THEN least(c.high, 2 * l.high - l.mid) ELSE c.high END END) AS s_max,
  max(CASE WHEN c.ratio = 'm' THEN CASE WHEN c.mid <= l.high THEN least(c.high, 2 * l.high - l.mid) ELSE c.high END END) AS m_max,
  max(CASE WHEN c.ratio = 'm' THEN CASE WHEN c.mid >= l.low THEN greatest(c.low, 2 * l.low - l.mid) ELSE c.low END END) AS m_min,
  max(CASE WHEN c.ratio = 'u' THEN CASE WHEN c.mid <= l.high THEN least(c.high, 2 * l.high - l.mid) ELSE c.high END END) AS u_max
  FROM f c JOIN f l ON c.kind = 2 AND l.kind = 1 AND c.lang IS NOT DISTINCT FROM l.lang AND c.ratio = l.ratio GROUP BY c.lang, c.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(bs <= s_max, true) AND coalesce(bm <= m_max, true) AND coalesce(bm >= m_min, true) AND coalesce(bu <= u_max, true) AS kept
FROM v LEFT JOIN z ON v.lang IS NOT DISTINCT FROM z.lang AND v.source IS NOT DISTINCT FROM z.source
"""

OP5_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE both_n * 5 >= (x.n + y.n - both_n) * 4),
r AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.c = e.a)
SELECT r.a AS doc_id, min(r.c) AS class_id, (SELECT count(*) FROM e WHERE e.a = r.a) AS n_links FROM r GROUP BY r.a
"""

OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": OP1_SQL, "op5_ngram_join": OP5_SQL, "op6_exact_top_k": OP6_SQL}
