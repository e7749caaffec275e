"""Registered queries of the training-data operators, and the DuckDB SQL where one exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm import lm_score, toxicity
from demandspark.llm.bpe import round_trip
from demandspark.llm.common import documents
from demandspark.llm.decontaminate import find_passages
from demandspark.llm.exact_dedup import exact_duplicates
from demandspark.llm.filter_audit import audit_filters
from demandspark.llm.length_histogram import count_tokens
from demandspark.llm.license_scan import scan_licenses
from demandspark.llm.packing import pack_documents
from demandspark.llm.resample import resample
from demandspark.llm.set_join import similar_documents
from demandspark.llm.sharding import shard_documents
from demandspark.llm.url_filter import Rule, judge_pages

URL_RULES = [Rule("com", "/", True), Rule("example.com", "/en/", False), Rule("www.example.com", "/en/", True),
             Rule("net", "/es/", False), Rule("net", "/fr/", False)]


def op1_qgram_lemma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("row")


def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = shard_documents(documents(spark, sf_dir), shards=8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")


def op3_subword_bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_documents(documents(spark, sf_dir), labels).drop("row")


def op4_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    return lm_score.score_documents(documents(spark, sf_dir), good).drop("row")


def op5_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir))


def op6_diagonal_voting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir)).drop("row")


def op7_link_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op8_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir)).drop("row")


def op10_set_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op11_window_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


def op12_radix_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_filter_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {
    "op1_qgram_lemma": op1_qgram_lemma,
    "op2_virtual_slots": op2_virtual_slots,
    "op3_subword_bags": op3_subword_bags,
    "op4_cross_entropy": op4_cross_entropy,
    "op5_length_histogram": op5_length_histogram,
    "op6_diagonal_voting": op6_diagonal_voting,
    "op7_link_propagation": op7_link_propagation,
    "op8_tree_bpe": op8_tree_bpe,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_set_relations": op10_set_relations,
    "op11_window_cuts": op11_window_cuts,
    "op12_radix_resample": op12_radix_resample,
    "op13_filter_orders": op13_filter_orders,
}

ORACLE_SQL = {
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op12_radix_resample": r"""
        WITH RECURSIVE crc_step(b, c, k) AS (
          SELECT CAST(range AS BIGINT), CAST(range AS BIGINT), 0 FROM range(256) UNION ALL
          SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_step WHERE k < 8),
        crc_table AS (SELECT b, c FROM crc_step WHERE k = 8),
        texts AS (
          SELECT 'd' AS side, doc_id, text, row_number() OVER () AS r FROM documents
          UNION ALL SELECT 't', NULL, text, row_number() OVER () FROM benchmark),
        split AS (
          SELECT side, doc_id, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
        counted AS (SELECT side, r, w, count(*) AS n FROM (SELECT side, r, unnest(w) AS w FROM split) GROUP BY ALL),
        vocabulary AS (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM counted)),
        crc(w, h, i, c) AS (
          SELECT w, h, 0, 4294967295 FROM vocabulary UNION ALL
          SELECT w, h, i + 1, xor(v.c >> 8, t.c) FROM crc v JOIN crc_table t
            ON t.b = xor(v.c & 255, CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) WHERE 2 * i < length(h)),
        bucketed AS (SELECT w, xor(c, 4294967295) % 10000 AS bucket FROM crc WHERE 2 * i = length(h)),
        features AS (SELECT side, r, bucket, n FROM counted JOIN bucketed USING (w)),
        sides AS (SELECT bucket, sum(CASE WHEN side = 'd' THEN n ELSE 0 END) AS s, sum(CASE WHEN side = 't' THEN n ELSE 0 END) AS t
                  FROM features GROUP BY bucket),
        totals AS (SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) AS s_all, CAST(coalesce(sum(t), 0) AS DOUBLE) AS t_all FROM sides),
        gains AS (SELECT bucket, floor(1000::DOUBLE * ln((CAST(t AS DOUBLE) + 1) * (s_all + 10000) / ((CAST(s AS DOUBLE) + 1) * (t_all + 10000)))) AS g
                  FROM sides, totals),
        weights AS (SELECT r, CAST(sum(n * g) AS BIGINT) AS weight FROM features JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
        scored AS (
          SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                 coalesce(weight, 0) + CAST(floor(-1000::DOUBLE * ln(-ln((CAST(('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT)
                                                                 + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
          FROM split LEFT JOIN weights USING (r) WHERE side = 'd'),
        ranked AS (SELECT *, n_features >= 20 AS able, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
                          count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 10 * n // 100 THEN place END AS rank FROM ranked""",
    "op13_filter_orders": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        failing AS (
          SELECT part, doc_id,
                 CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
                 || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
                 || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
                 || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
                 || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS f
          FROM words),
        judged AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
        cells AS (SELECT part, f, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
                  FROM failing LEFT JOIN judged USING (doc_id) GROUP BY part, f),
        orders(filter_order) AS (
          SELECT '' UNION ALL
          SELECT filter_order || l FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) x WHERE NOT contains(filter_order, l)),
        steps AS (SELECT filter_order, s AS step, substr(filter_order, s, 1) AS letter, substr(filter_order, 1, s - 1) AS earlier
                  FROM orders, range(1, 6) r(s) WHERE length(filter_order) = 5),
        outcome AS (SELECT part, filter_order, step, letter, f, n, good, toxic, contains(f, letter) AS fails,
                           len(list_intersect(string_split(f, ''), string_split(earlier, ''))) > 0 AND f <> '' AND earlier <> '' AS gone
                    FROM steps, cells),
        metrics AS (SELECT part, filter_order, step, letter,
                           sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept,
                           sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
                           sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant,
                           sum(CASE WHEN f = letter THEN n ELSE 0 END) AS unique_fails,
                           sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost,
                           sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
                    FROM outcome GROUP BY ALL)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
        FROM metrics""",
}
