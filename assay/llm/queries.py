"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import (
    decontaminate,
    exact_repeats,
    langid,
    licences,
    lm,
    packing,
    pages,
    quality,
    repair,
    simhash,
    substring,
    topk,
    trie,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return topk.top_k(vectors.where("vec_id % 50 = 0"), vectors, k=5)


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents")).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.held_out_scores(table(spark, folder, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.repeated_passages(table(spark, folder, "documents")).drop("text_hash")


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_copies(table(spark, folder, "documents")).select(
        "doc_id",
        simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(*trie.branched(table(spark, folder, "conversations")))


def op12_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return repair.repairs(repair.damaged(conversations), conversations)


def op13_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_repeats.repeats(table(spark, folder, "documents"), texts_too=False).drop("kept")


QUERIES: dict[str, Query] = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_packing": op2_packing,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_html_extraction": op7_html_extraction,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_language_id": op9_language_id,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_structure_repair": op12_structure_repair,
    "op13_suffix_array_dedup": op13_suffix_array_dedup,
}

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE: dict[str, str] = {
    "op1_exact_top_k": """
        WITH v AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id
            WHERE q.vec_id % 50 = 0
        )
        SELECT query_id,
               row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
               vec_id, score
        FROM scored QUALIFY rank <= 5
    """,
    "op6_benchmark_decontamination": f"""
        WITH d AS (
            SELECT doc_id, coalesce(
                regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_WORD}'), []) AS w
            FROM documents
        ), b AS (
            SELECT item_id,
                regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w
            FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS size, w[s : s + least(len(w), 10) - 1] AS t
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s
                  FROM b WHERE len(w) > 0)
        ), sizes AS (SELECT DISTINCT size FROM windows
        ), spans AS (
            SELECT doc_id, size, s, w[s : s + size - 1] AS t
            FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s
                  FROM d, sizes WHERE len(w) >= size)
        ), found AS (
            SELECT doc_id, s, size, item_id FROM spans JOIN windows USING (size, t)
        ), hits AS (
            SELECT doc_id, count(DISTINCT p) AS n
            FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM found) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id
        )
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit,
               coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
               coalesce(hits.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op11_prefix_trie": """
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
            FROM conversations WHERE conv_id IS NOT NULL
        ), c AS (
            SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
                lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                    lambda a, i: xor(a >> 1, 3988292384 * (a & 1))))) % 6 AS h
            FROM t
        ), paths AS (
            SELECT conv_id, coalesce(list({'role': role, 'text': text} ORDER BY own, p)
                                     FILTER (WHERE p IS NOT NULL), []) AS path
            FROM (SELECT c.conv_id, 0 AS own, t.* EXCLUDE conv_id
                  FROM c LEFT JOIN t ON t.conv_id = c.base AND t.p <= c.h
                  UNION ALL SELECT conv_id, 1, t.* EXCLUDE conv_id FROM c JOIN t USING (conv_id) WHERE p > h)
            GROUP BY conv_id
        ), nodes AS (
            SELECT path[1:d] AS node, d, min(conv_id) AS conv_id, count(*) AS n, max(len(path)) = d AS leaf,
                   (count(*) - 1) * coalesce(max(length(path[d].text)), 0) AS saved,
                   coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                            FILTER (WHERE len(path) = d), '') AS ids
            FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths) GROUP BY path[1:d], d
        ), sums AS (
            SELECT node[1:k] AS node, k AS d, sum(leaf::BIGINT)::BIGINT AS leaves, sum(saved)::BIGINT AS saved,
                   count(*) FILTER (WHERE d = k + 1) AS children
            FROM (SELECT *, unnest(range(d + 1)) AS k FROM nodes) GROUP BY node[1:k], k
        )
        SELECT nodes.conv_id, nodes.d AS depth, parent.conv_id AS parent_conv_id, nodes.n AS n_convs,
               sums.children AS n_children, sums.leaves AS n_leaves, sums.saved AS saved_tokens,
               sha256(nodes.ids) AS ends_sha256
        FROM nodes JOIN sums ON sums.node = nodes.node AND sums.d = nodes.d
        LEFT JOIN nodes parent ON nodes.d = parent.d + 1 AND parent.node = nodes.node[1 : nodes.d - 1]
    """,
}
