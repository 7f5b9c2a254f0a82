"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import audit, clusters, contamination, extract, mixing, near_dup, packing, quality, repeats, topk, url_filter, vectors, warc

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    cut = repeats.cut_repeats(docs, keep_first=False)
    cut = cut.select("id", "th", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("sha"))
    text = F.coalesce("text", F.lit("")).cast("binary")
    whole = docs.select("doc_id", *repeats.text_key(), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    none = F.lit(0).cast("long")
    return whole.join(cut, ["id", "th"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256")
    )


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.match_urls(pages, url_filter.rule_table(spark, URL_RULES)).drop("url")


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.near_vectors(_table(spark, sf_dir, "embeddings"))
    return found.select(
        "vec_id", F.col("_links").alias("n_links"), F.col("_component").alias("component_id"), (F.col("vec_id") == F.col("_component")).alias("kept")
    )


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(_table(spark, sf_dir, "documents"))
    return scored.select("doc_id", F.col("_quality").alias("score"), (F.col("_quality") >= quality.KEEP).alias("kept"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, percent=80)
    return found.select(
        "doc_id", F.col("_n").alias("n_shingles"), F.col("_component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("_component")).alias("kept")
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    written = warc.write_archives(_table(spark, sf_dir, "pages"), f"{folder}/monolithic")
    index = warc.normalise(written, f"{folder}/members")
    return warc.read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract.main_text(_table(spark, sf_dir, "pages"), carry=["page_id", "url"])
    return pages.select("page_id", "url", F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"),
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters.centroid_clusters(_table(spark, sf_dir, "embeddings"))
    names = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return found.select("vec_id", *[F.col(f"_{name}").alias(name) for name in names])


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"), F.col("_n_items").alias("n_items"),
        F.sha2(F.concat_ws(",", "_items"), 256).alias("items_sha256"), (F.col("_n_hit") > 0).alias("contaminated"),
    )


def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_interactions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_suffix_array_dedup, op2_url_filters, op3_embedding_near_dedup, op4_exact_top_k, op5_quality_classifier,
        op6_minhash_near_dedup, op7_best_fit_packing, op8_warc, op9_html_extraction, op10_mix_sources,
        op11_centroid_clustering, op12_benchmark_decontamination, op13_filter_interaction_audit,
    )
}

_URL_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS r
  FROM pages
), parts AS (
  SELECT page_id, regexp_extract(r, '^[^/?#]*') AS h, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), hosts AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts
), rules(rhost, rpath, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), addresses AS (SELECT DISTINCT host, path FROM hosts), fits AS (
  SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM addresses JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM hosts LEFT JOIN fits USING (host, path)
"""

_TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, [cast(floor(64 * cast(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, cast(list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
), ranked AS (
  SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""



def _cluster_sql(k: int = 16, rounds: int = 3) -> str:
    """Assigning and averaging, written out round by round over (vec_id, components)."""
    steps = [
        """v AS (
  SELECT vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS cluster, q AS c FROM v ORDER BY sha256('1:' || vec_id), q LIMIT {k}
)""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS (
  SELECT vec_id, q, cluster, cast(list_sum(list_transform(list_zip(q, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance FROM v CROSS JOIN c{r}
), a{r} AS (
  SELECT vec_id, any_value(q) AS q, min(struct_pack(distance := distance, cluster := cluster)) AS best FROM d{r} GROUP BY vec_id
)""")
        if r < rounds:
            steps.append(f"""u{r} AS (
  SELECT best.cluster AS cluster, place, sum(q[place]) AS s, count(*) AS n FROM a{r} CROSS JOIN range(1, 65) t(place) GROUP BY 1, 2
), m{r} AS (
  SELECT cluster, list(cast((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS c FROM u{r} GROUP BY cluster
), c{r + 1} AS (
  SELECT cluster, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (cluster)
)""")
    return (
        "WITH "
        + ", ".join(steps)
        + f"""
SELECT vec_id, cast(cluster AS INTEGER) AS cluster, best.distance AS distance,
  cast(sum(best.distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, cast(sum(best.distance) OVER () AS BIGINT) AS inertia,
  sha256(list_aggregate(c, 'string_agg', ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON cluster = best.cluster
"""
    )


_CONTAMINATION_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), phrases AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM phrases), texts AS (SELECT DISTINCT size, phrase FROM phrases), places AS (
  SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size
), found AS (
  SELECT rid, i, size, phrase FROM (SELECT rid, i, size, array_to_string(w[i : i + size - 1], ' ') AS phrase FROM places) SEMI JOIN texts USING (size, phrase)
), hit AS (
  SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS j FROM found) GROUP BY rid
), held AS (
  SELECT rid, count(*) AS n_items, string_agg(cast(item_id AS VARCHAR), ',' ORDER BY cast(item_id AS VARCHAR)) AS items
  FROM (SELECT DISTINCT rid, item_id FROM (SELECT DISTINCT rid, size, phrase FROM found) JOIN phrases USING (size, phrase)) GROUP BY rid
)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN held USING (rid)
"""

_AUDIT_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents), w AS (
  SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first_id FROM t
), marks AS (
  SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    concat(CASE WHEN len(w) < 200 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
      CASE WHEN 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 2 * length(t) THEN 'C' ELSE '' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END, CASE WHEN doc_id > first_id THEN 'E' ELSE '' END) AS failed
  FROM w LEFT JOIN marks USING (doc_id)
), cells AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM fails GROUP BY part, failed
), f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')), orders AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, cast(step AS INTEGER) AS step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS past FROM orders, range(1, 6) r(step)
), counted AS (
  SELECT part, filter_order, step, own, n, good, toxic, failed = own AS only_own, contains(failed, own) AS fail,
    past <> '' AND regexp_matches(failed, concat('[', past, '-]')) AS gone
  FROM cells, steps
), summed AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT fail AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (fail AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (fail AND gone), 0) AS redundant, coalesce(sum(n) FILTER (only_own), 0) AS unique_fails,
    coalesce(sum(good) FILTER (fail AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (fail AND NOT gone), 0) AS toxic_lost
  FROM counted GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, cast(kept AS BIGINT) AS kept, cast(removed AS BIGINT) AS removed, cast(redundant AS BIGINT) AS redundant,
  cast(unique_fails AS BIGINT) AS unique_fails, cast(good_lost AS BIGINT) AS good_lost, cast(toxic_lost AS BIGINT) AS toxic_lost,
  cast(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM summed
"""

ORACLE = {"op2_url_filters": _URL_SQL, "op4_exact_top_k": _TOP_K_SQL, "op11_centroid_clustering": _cluster_sql(), "op12_benchmark_decontamination": _CONTAMINATION_SQL, "op13_filter_interaction_audit": _AUDIT_SQL}
