"""The registered queries of this subpackage, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.llm import (
    centroids,
    exact_dedup,
    html_text,
    language_id,
    line_dedup,
    packing,
    resampling,
    sentencepiece_codec,
    simhash,
    suffix_dedup,
    token_files,
    toxicity,
    vector_dedup,
)
from crawlframe.llm.batches import held_out
from crawlframe.session import scratch_path

VOCABULARY, PIECES = "word_bpe_49k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = held_out("doc_id", 5, 0)
    model = language_id.train(docs.filter(~held))
    found = language_id.predict(docs.select("doc_id", "text"), model, "doc_id")
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"), "page_id", "url")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


OP3 = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
), g AS (
  SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trips(table(spark, sf_dir, "documents"), "doc_id", model=tokenizer_path(PIECES))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), held_out("doc_id", 3, 1)
    model = toxicity.train(docs.filter(~held), table(spark, sf_dir, "labels").filter(~held))
    found = toxicity.score(docs.select("doc_id", "text"), model, "doc_id")
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary=tokenizer_path(VOCABULARY), end_id=2)
    return token_files.document_index(spark, path)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary=tokenizer_path(VOCABULARY), end_id=1, length=2048)


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


OP10 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT r.a, l.b FROM reach r JOIN l ON l.a = r.b
), c AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
), n AS (
  SELECT a, count(*) AS n_links FROM l GROUP BY a
)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64, scale=256, seed=2)


def centroid_sql(k: int, rounds: int) -> str:
    """Every round as two steps: the nearest centroid of each vector, then the floored means."""
    steps = [
        """
WITH v AS MATERIALIZED (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS BIGINT) AS cl, e AS c
  FROM v QUALIFY cl < """
        + f"{k}\n)"
    ]
    for turn in range(rounds + 1):
        steps.append(f""", d{turn} AS (
  SELECT vec_id, e, cl, CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(e, c)]) AS BIGINT) AS d
  FROM v CROSS JOIN c{turn}
), a{turn} AS MATERIALIZED (
  SELECT vec_id, e, min(d * {k} + cl) AS m FROM d{turn} GROUP BY vec_id, e
)""")
        if turn < rounds:
            steps.append(f""", x{turn} AS (
  SELECT m % {k} AS cl, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{turn}
), s{turn} AS (
  SELECT cl, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM x{turn} GROUP BY cl, i
), u{turn} AS (
  SELECT cl, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{turn} GROUP BY cl
), c{turn + 1} AS MATERIALIZED (
  SELECT p.cl, coalesce(u.c, p.c) AS c FROM c{turn} p LEFT JOIN u{turn} u ON u.cl = p.cl
)""")
    return "".join(steps) + f"""
SELECT a.vec_id, CAST(p.cl AS INTEGER) AS cluster, CAST(a.m // {k} AS BIGINT) AS distance,
  CAST(sum(a.m // {k}) OVER (PARTITION BY p.cl) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.m // {k}) OVER () AS BIGINT) AS inertia, sha256(array_to_string(p.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} p ON p.cl = a.m % {k}
"""


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


OP12 = """
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT doc_id, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM d
), k AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM l
), n AS (
  SELECT *, translate(bare, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM k
), f AS (
  SELECT *, CASE WHEN length(bare) >= 10 THEN min(doc_id) OVER (PARTITION BY norm) < doc_id ELSE FALSE END AS gone FROM n
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, goal = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampling.resample(documents, goal, percent=10, buckets=10_000, grams=1, min_words=20, seed=2024)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_language_id,
        op2_html_text,
        op3_exact_dedup,
        op4_suffix_dedup,
        op5_sentencepiece,
        op6_simhash,
        op7_toxicity,
        op8_token_files,
        op9_packing,
        op10_vector_dedup,
        op11_centroids,
        op12_line_dedup,
        op13_resampling,
    )
}
ORACLES: dict[str, str] = {
    "op3_exact_dedup": OP3,
    "op10_vector_dedup": OP10,
    "op11_centroids": centroid_sql(40, 5),
    "op12_line_dedup": OP12,
}
