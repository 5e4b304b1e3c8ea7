"""One query per operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm import align, bpe, decontam, html, importance, markov, minhash, pii, secrets, substring, topk, toxicity, warc
from lakestar.llm.common import scratch
from lakestar.llm.spans import count_of, listed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


@query("""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
""")
def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.as_integers(F.col("embedding")).alias("v"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5)


WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


@query(rf"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
r(doc_id, component_id) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT c.b, r.component_id FROM r JOIN c ON c.a = r.doc_id AND r.component_id < c.b)
SELECT doc_id, CAST(len(any_value(s)) AS BIGINT) AS n_shingles, min(component_id) AS component_id,
  doc_id = min(component_id) AS kept
FROM s JOIN r USING (doc_id) GROUP BY doc_id
""")
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)
""")
def op3_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.check_warc(warc.read_warc(spark, path)).select(
        F.col("id").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
    )


@query()
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, path, pattern, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


@query(r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w)),
f AS (SELECT x, min(doc_id) AS first FROM p GROUP BY x),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM p JOIN f USING (x) WHERE first < doc_id),
l AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id),
k AS (SELECT doc_id, w, coalesce(gone, []) AS gone FROM w LEFT JOIN l USING (doc_id))
SELECT doc_id, len(w) AS n_words, len(gone) AS n_removed,
  sha256(coalesce(array_to_string(list_select(w, list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i))), ' '), ''))
    AS kept_sha256
FROM k
""")
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", sha256(F.col("kept")).alias("kept_sha256"))


@query()
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [r.kind for r in secrets.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *(count_of(F.col("spans"), k).alias(f"n_{k}") for k in kinds),
        sha256(listed(base)).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(pii.BASE))
    return found.select(
        "doc_id",
        *(count_of(F.col("spans"), k).alias(f"n_{k}") for k in pii.BASE),
        sha256(listed(base)).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query()
def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query(r"""
WITH b AS (
  SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
i AS (SELECT item_id, w, len(w) AS n, least(len(w), 5) AS k FROM b WHERE len(w) > 0),
y AS (
  SELECT item_id, n, k, x, count(*) AS c FROM (
    SELECT item_id, n, k, array_to_string(w[p:p + k - 1], ' ') AS x
    FROM (SELECT *, unnest(range(1, n - k + 2)) AS p FROM i)) GROUP BY ALL),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, k, p, len(w) AS size, array_to_string(w[p:p + k - 1], ' ') AS x
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM i))),
h AS (SELECT s.doc_id, y.item_id, y.n, y.k, s.p, s.size, s.x, y.c FROM s JOIN y ON s.x = y.x AND s.k = y.k),
m AS (
  SELECT a.doc_id, a.item_id, a.n, a.k, a.p, a.size, z.x, least(count(*), any_value(z.c)) AS common
  FROM h a JOIN h z ON a.doc_id = z.doc_id AND a.item_id = z.item_id AND z.p BETWEEN a.p AND a.p + a.n - a.k
  GROUP BY ALL),
t AS (
  SELECT doc_id, item_id, n, p - 1 AS start, CAST(sum(common) AS BIGINT) AS shared,
    least(n - k + 1, size - k + 1 - (p - 1)) + n - k + 1 AS total
  FROM m GROUP BY doc_id, item_id, n, k, p, size)
SELECT doc_id, item_id, shared / (total - shared) AS similarity, start, n AS n_words FROM t
WHERE 175 * shared >= 75 * total
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY shared / (total - shared) DESC, start) = 1
""")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path_a, path_b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = align.align(table(spark, sf_dir, "documents"), path_a, path_b, public_tokenizers.PATTERN)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query(r"""
WITH t0 AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS x FROM benchmark),
e AS (SELECT doc_id, unnest(w) AS x FROM d),
v AS (SELECT x, hex(encode(x)) AS h FROM (SELECT x FROM e UNION SELECT x FROM b)),
c AS (
  SELECT x, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2),
      lambda i: 16 * (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)),
    lambda c, z: xor(c // 256, t[xor(c % 256, z) + 1])), 4294967295) % 10000 AS k FROM v, t0),
s AS (SELECT k, count(*) AS s FROM e JOIN c USING (x) GROUP BY k),
u AS (SELECT k, count(*) AS t FROM b JOIN c USING (x) GROUP BY k),
g AS (
  SELECT k, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * CAST((SELECT count(*) FROM e) + 10000 AS DOUBLE)
    / ((s + 1) * CAST((SELECT count(*) FROM b) + 10000 AS DOUBLE)))) AS BIGINT) AS g
  FROM s LEFT JOIN u USING (k)),
m AS (SELECT doc_id, CAST(floor(sum(g) / count(*)) AS BIGINT) AS w FROM e JOIN c USING (x) JOIN g USING (k) GROUP BY doc_id),
h AS (SELECT doc_id, len(w) AS n, sha256('2024:' || doc_id) AS h FROM d),
z AS (
  SELECT doc_id, CAST(n AS BIGINT) AS n_features, coalesce(w, 0) AS weight,
    coalesce(w, 0) + CAST(floor(-1000 * ln(-ln((list_reduce(list_transform(range(1, 9),
      lambda i: CAST(strpos('0123456789abcdef', h[i]) - 1 AS BIGINT)), lambda a, z: 16 * a + z) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM h LEFT JOIN m USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM z WHERE n_features >= 20),
q AS (SELECT doc_id, r FROM r WHERE r <= (SELECT count(*) * 10 // 100 FROM r))
SELECT z.*, r AS rank FROM z LEFT JOIN q USING (doc_id)
""")
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query()
def op13_markov_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return markov.score_texts(table(spark, sf_dir, "documents"), held_out)
