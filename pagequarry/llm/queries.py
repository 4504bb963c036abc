"""The queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagequarry.llm._common import table
from pagequarry.llm.decontamination import leaks
from pagequarry.llm.labelled import held_out
from pagequarry.llm.mixing import DEFAULT_WEIGHTS, default_levels, mix
from pagequarry.llm.near_duplicates import classes
from pagequarry.llm.quality import quality
from pagequarry.llm.secret_scan import ranked_words, secret_scan
from pagequarry.llm.sharding import shards
from pagequarry.llm.suffix_dedup import without_repeats
from pagequarry.llm.token_counts import token_counts
from pagequarry.llm.toxicity import toxicity
from pagequarry.llm.vector_search import top_k


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"), count=40)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = ranked_words(vocabulary_path("byte_bpe_50k.json"))
    return secret_scan(table(spark, sf_dir, "documents"), words=words).drop("found")


def secret_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op5 that SQL can say: base spans by kind."""
    return op5_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


SECRET_BASE_SQL = r"""
SELECT doc_id, len(list_filter(regexp_extract_all(t, '(?:(?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1), lambda x: length(x) >= 12)) AS n_assign,
len(list_filter(regexp_extract_all(t, 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 18)) AS n_access, len(list_filter(regexp_extract_all(t, '[0-9a-f]+'), lambda x: length(x) >= 16)) AS n_hex
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
"""


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = mix(docs, levels=default_levels(), weights=DEFAULT_WEIGHTS, budget_share=0.8, max_epochs=2, seed=42)
    return out.select("doc_id", "mix__.domain", "mix__.lang", "mix__.source", "mix__.tokens", "mix__.epoch", "mix__.draw")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op8_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors.where("vec_id % 50 = 0"), vectors, k=5, scale=256.0)


OP8_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, generate_subscripts(c, 1) AS i, unnest(c) AS x, len(c) AS n FROM v),
s AS (SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(sum(q.x * d.x) AS BIGINT) AS score
      FROM e q JOIN e d ON q.i = d.i AND q.n = d.n AND q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""


def covered_sql(width: int) -> str:
    """Runs (r, a, b) of bytes that strings of a width which also start elsewhere cover, from texts t (r, h: hexadecimal, n: bytes)."""
    windows = f"SELECT r, p, md5(substr(h, 2 * p + 1, {2 * width})) AS m FROM (SELECT r, h, unnest(range(0, n - {width - 1})) AS p FROM t WHERE n >= {width})"
    return f"""w{width} AS MATERIALIZED ({windows}), s{width} AS (SELECT r, p FROM w{width} WHERE m IN (SELECT m FROM w{width} GROUP BY m HAVING count(*) > 1)),
c{width} AS (SELECT r, min(p) AS a, max(p) + {width} AS b FROM (SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS g FROM (
SELECT r, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= {width} THEN 0 ELSE 1 END AS fresh FROM s{width})) GROUP BY r, g)"""


OP7_SQL = f"""
WITH t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
{covered_sql(400)}, {covered_sql(256)},
gaps AS (SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS x, a AS y FROM c400 UNION ALL SELECT c400.r, max(b), any_value(n) FROM c400 JOIN t USING (r) GROUP BY c400.r),
kept AS (SELECT r, string_agg(substr(h, CAST(2 * x + 1 AS BIGINT), CAST(2 * (y - x) AS BIGINT)), '' ORDER BY x) AS h FROM gaps JOIN t USING (r) GROUP BY r),
removed AS (SELECT r, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM c400 GROUP BY r), passages AS (SELECT r, CAST(sum(b - a) AS BIGINT) AS n FROM c256 GROUP BY r)
SELECT doc_id, t.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, t.h))) AS kept_sha256, coalesce(passages.n, 0) AS n_passage_bytes
FROM t LEFT JOIN removed USING (r) LEFT JOIN kept USING (r) LEFT JOIN passages USING (r)
"""

OP9_SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents), nodes AS MATERIALIZED (SELECT min(r) AS v, text FROM d GROUP BY text),
words AS (SELECT v, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM nodes), cut AS (SELECT v, w, least(5, len(w)) AS k FROM words WHERE len(w) > 0),
shingles AS MATERIALIZED (SELECT v, x, row_number() OVER (PARTITION BY v, x) AS nth FROM (SELECT v, array_to_string(w[i + 1:i + k], ' ') AS x FROM (SELECT v, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM cut))),
sizes AS (SELECT v, count(*) AS n FROM shingles GROUP BY v), common AS (SELECT a.v AS a, b.v AS b, count(*) AS met FROM shingles a JOIN shingles b ON a.x = b.x AND a.nth = b.nth AND a.v < b.v GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM common JOIN sizes p ON p.v = a JOIN sizes q ON q.v = b WHERE met >= 0.8 * (p.n + q.n - met)), every AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT v AS a, v AS b FROM nodes UNION SELECT reach.a, every.b FROM reach JOIN every ON reach.b = every.a)
SELECT d.doc_id, min(m.doc_id) AS class_id FROM d JOIN nodes n ON n.text = d.text JOIN reach ON reach.a = n.v JOIN nodes o ON o.v = reach.b JOIN d m ON m.text = o.text GROUP BY d.r, d.doc_id
"""


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out().alias("held_out"), "quality__.expected_grade", "quality__.tail", "quality__.keep")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_decontamination": op2_decontamination,
        "op3_toxicity": op3_toxicity,
        "op4_sharding": op4_sharding,
        "op5_secret_scan": op5_secret_scan,
        "secret_base_counts": secret_base_counts,
        "op6_mixing": op6_mixing,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_vector_search": op8_vector_search,
        "op9_near_duplicates": op9_near_duplicates,
        "op10_quality": op10_quality,
    }


def oracle_sql() -> dict[str, str]:
    return {"secret_base_counts": SECRET_BASE_SQL, "op7_suffix_dedup": OP7_SQL, "op8_vector_search": OP8_SQL, "op9_near_duplicates": OP9_SQL}
