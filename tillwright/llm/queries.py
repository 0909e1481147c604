"""The queries of this folder, each over its whole table, and the SQL they are checked by."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.byte_bpe import digests, map_encoded
from tillwright.llm.common import table
from tillwright.llm.grid_join import near_duplicate_vectors
from tillwright.llm.line_dedup import drop_repeated_lines
from tillwright.llm.line_labels import quality_report
from tillwright.llm.ngram_trie import language_model_report
from tillwright.llm.norm_buckets import ranked_search
from tillwright.llm.packing import pack_documents
from tillwright.llm.token_files import token_file_report
from tillwright.llm.toxicity import toxicity_report
from tillwright.llm.trie_join import similar_documents
from tillwright.llm.turn_repair import damage_turns, repair_turns
from tillwright.llm.va_file import exact_top_k
from tillwright.llm.warc import archive_report


def op1_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op2_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"), words=4, least=85, scale=100)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_report(spark, table(spark, sf_dir, "pages"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_file_report(table(spark, sf_dir, "documents"), path, end_id=0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(table(spark, sf_dir, "documents"), similarity=0.8, by_pieces=True, every_line=True)


def op7_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_report(table(spark, sf_dir, "documents"))


def op8_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(table(spark, sf_dir, "documents"), path, end_id=2)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_encoded(table(spark, sf_dir, "documents"), path, digests, columns)


def op11_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_line_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_turns(damage_turns(table(spark, sf_dir, "conversations")), copies="copies")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_grid_join, op2_trie_join, op3_warc, op4_token_files, op5_toxicity, op6_line_dedup,
        op7_ngram_trie, op8_va_file, op9_packing, op10_byte_bpe,
        op11_norm_buckets, op12_line_labels, op13_turn_repair,
    )
}

ORACLES: dict[str, str] = {
    "op1_grid_join": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e
            FROM embeddings
        ), link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
            ON a.label = b.label AND a.vec_id <> b.vec_id
            AND list_cosine_similarity(a.e, b.e) >= 0.98
        ), reach(a, b) AS (
            SELECT vec_id, vec_id FROM v
            UNION
            SELECT r.a, link.b FROM reach r JOIN link ON r.b = link.a
        ), component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT v.vec_id, (SELECT count(*) FROM link WHERE link.a = v.vec_id) AS n_links,
            component_id, v.vec_id = component_id AS kept
        FROM v JOIN component USING (vec_id)
    """,
    "op3_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload, strlen(payload) AS payload_bytes,
                sha1(payload) AS payload_digest
            FROM pages
        ), judged AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 1000 AND page_id < largest
                THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN largest END AS refers_to
        FROM judged
    """,
    "op8_va_file": """
        WITH v AS (
            SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS e
            FROM embeddings
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n
            FROM scored
        )
        SELECT query_id, n::INTEGER AS rank, vec_id, score FROM ranked WHERE n <= 10
    """,
    "op11_norm_buckets": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), i AS (
            SELECT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), wanted AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL),
        total AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS terms FROM d WHERE len(terms) > 0),
        tf AS (
            SELECT doc_id, len(terms) AS n, term, count(*) AS tf
            FROM (SELECT doc_id, terms, unnest(terms) AS term FROM d)
            WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, terms, term
        ), weight AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM tf, total GROUP BY term, docs
        ), scored AS (
            SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf)
                // (1000 * tf + 8 * (100 - 75 + (75 * n * total.docs) // total.terms))))::BIGINT AS score
            FROM wanted JOIN tf USING (term) JOIN weight USING (term), total
            GROUP BY item_id, doc_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS n
            FROM scored WHERE score > 0
        )
        SELECT item_id, n::INTEGER AS rank, doc_id, score FROM ranked WHERE n <= 10
    """,
    "op13_turn_repair": r"""
        WITH RECURSIVE keyed AS (
            -- CRC-32, a bit at a time
            SELECT *, xor(list_reduce([4294967295] || [ascii(c)::BIGINT FOR c IN string_split(
                    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')],
                lambda crc, byte: list_reduce([xor(crc, byte)] || range(8),
                    lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS pick
            FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text
                FROM conversations)
        ), damaged AS (
            SELECT conv_id, turn, CASE pick WHEN 4 THEN 'user' ELSE role END AS role,
                CASE pick WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                unnest(range(CASE pick WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM keyed
        ), placed AS (
            SELECT *, row_number() OVER place AS pos, left(role, 1) AS initial,
                lag(left(role, 1)) OVER place AS initial_before,
                right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS mark,
                row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
            FROM damaged
            WINDOW place AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                md5(length(role)::VARCHAR || ':' || role || text), copy)
        ), judged AS (
            SELECT *, CASE WHEN mark = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                WHEN mark NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
            FROM placed
        ), counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (fault = 'blank') AS blank,
                count(*) FILTER (fault = 'duplicate') AS duplicate,
                count(*) FILTER (fault = 'truncated') AS truncated,
                count(*) FILTER (pos > 1 AND initial_before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
                count(*) AS length
            FROM judged GROUP BY conv_id
        ), back AS (
            -- From the last row to the first: what is cheapest from each state on (0 nothing yet,
            -- 1 system, 2 user, 3 assistant), as cost, audit and what is said.
            SELECT conv_id, length AS pos, {'cost': 0, 'audit': '', 'said': ''} AS s0,
                {'cost': 10, 'audit': 'II', 'said': chr(10) || 'user:' || chr(10) || 'assistant:'} AS s1,
                {'cost': 5, 'audit': 'I', 'said': chr(10) || 'assistant:'} AS s2,
                {'cost': 0, 'audit': '', 'said': ''} AS s3
            FROM counted
            UNION ALL
            SELECT conv_id, pos, f0,
                list_sort([f1, {'cost': f2.cost + 5, 'audit': 'I' || f2.audit, 'said': chr(10) || 'user:' || f2.said}])[1],
                list_sort([f2, {'cost': f3.cost + 5, 'audit': 'I' || f3.audit, 'said': chr(10) || 'assistant:' || f3.said}])[1],
                f3
            FROM (
                SELECT conv_id, pos,
                    list_sort([g0, {'cost': g2.cost + 5, 'audit': 'I' || g2.audit, 'said': chr(10) || 'user:' || g2.said},
                        {'cost': g3.cost + 10, 'audit': 'II' || g3.audit, 'said': chr(10) || 'user:' || chr(10) || 'assistant:' || g3.said}])[1] AS f0,
                    list_sort([g1, {'cost': g2.cost + 5, 'audit': 'I' || g2.audit, 'said': chr(10) || 'user:' || g2.said},
                        {'cost': g3.cost + 10, 'audit': 'II' || g3.audit, 'said': chr(10) || 'user:' || chr(10) || 'assistant:' || g3.said}])[1] AS f1,
                    list_sort([g2, {'cost': g3.cost + 5, 'audit': 'I' || g3.audit, 'said': chr(10) || 'assistant:' || g3.said}])[1] AS f2,
                    list_sort([g3, {'cost': g2.cost + 5, 'audit': 'I' || g2.audit, 'said': chr(10) || 'user:' || g2.said}])[1] AS f3
                FROM (
                    SELECT b.conv_id, b.pos - 1 AS pos,
                        list_sort(list_filter([
                            {'cost': s0.cost + 2, 'audit': 'D' || s0.audit, 'said': s0.said},
                            CASE WHEN stays AND initial = 's' THEN {'cost': s1.cost + extra, 'audit': 'K' || s1.audit, 'said': line || s1.said} END,
                            CASE WHEN stays AND initial = 'u' THEN {'cost': s2.cost + extra, 'audit': 'K' || s2.audit, 'said': line || s2.said} END,
                            CASE WHEN stays THEN {'cost': s2.cost + extra + 1, 'audit': 'R' || s2.audit, 'said': chr(10) || 'user:' || text || s2.said} END
                        ], lambda x: x IS NOT NULL))[1] AS g0,
                        list_sort(list_filter([
                            {'cost': s1.cost + 2, 'audit': 'D' || s1.audit, 'said': s1.said},
                            CASE WHEN stays AND initial = 'u' THEN {'cost': s2.cost + extra, 'audit': 'K' || s2.audit, 'said': line || s2.said} END,
                            CASE WHEN stays THEN {'cost': s2.cost + extra + 1, 'audit': 'R' || s2.audit, 'said': chr(10) || 'user:' || text || s2.said} END
                        ], lambda x: x IS NOT NULL))[1] AS g1,
                        list_sort(list_filter([
                            {'cost': s2.cost + 2, 'audit': 'D' || s2.audit, 'said': s2.said},
                            CASE WHEN stays AND initial = 'a' THEN {'cost': s3.cost + extra, 'audit': 'K' || s3.audit, 'said': line || s3.said} END,
                            CASE WHEN stays THEN {'cost': s3.cost + extra + 1, 'audit': 'R' || s3.audit, 'said': chr(10) || 'assistant:' || text || s3.said} END
                        ], lambda x: x IS NOT NULL))[1] AS g2,
                        list_sort(list_filter([
                            {'cost': s3.cost + 2, 'audit': 'D' || s3.audit, 'said': s3.said},
                            CASE WHEN stays AND initial = 'u' THEN {'cost': s2.cost + extra, 'audit': 'K' || s2.audit, 'said': line || s2.said} END,
                            CASE WHEN stays THEN {'cost': s2.cost + extra + 1, 'audit': 'R' || s2.audit, 'said': chr(10) || 'user:' || text || s2.said} END
                        ], lambda x: x IS NOT NULL))[1] AS g3
                    FROM back b JOIN (
                        SELECT *, fault IN ('', 'truncated') AS stays,
                            CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra,
                            chr(10) || role || ':' || text AS line
                        FROM judged
                    ) j ON b.conv_id IS NOT DISTINCT FROM j.conv_id AND b.pos = j.pos
                )
            )
        )
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
            coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
            coalesce(illegal, 0) AS illegal, coalesce(s0.cost, 0)::BIGINT AS cost,
            coalesce(s0.audit, '') AS audit, sha256(coalesce(s0.said[2:], '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN back b ON o.conv_id IS NOT DISTINCT FROM b.conv_id AND b.pos = 0
    """,
}
