"""The registered queries of the llm operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postwave.llm import (collocations, html_extract, importance, katz_lm, knn_join, line_chunks, near_dup, prefix_trie, quality_rules, sentencepiece_bpe, template_decontam, url_rules,
                          warc_bundles)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def model_path() -> str:
    """The public 32k BPE model; another environment passes its own path to the operator."""
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are the given rules' verdicts on the pages they cover (most of them block, so no lift can be great): the labels table is
    of documents, not of pages."""
    return url_rules.judge(table(spark, sf_dir, "pages"), min_lift=1.2)


def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = template_decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("n_hits").cast("long").alias("n_hits"), F.col("n_windows").cast("long").alias("n_windows"))


def op3_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_chunks.dedup(table(spark, sf_dir, "documents"))
    return done.select("doc_id", F.col("__removed").alias("removed_lines"), F.length("text").cast("long").alias("n_chars"), "text")


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op5_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op7_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_bundles.archive_and_read(spark, table(spark, sf_dir, "pages"))


def op8_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_lm.score(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encode_decode(table(spark, sf_dir, "documents"), model_path())


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_join.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_rules": op1_url_rules,
    "op2_template_decontamination": op2_template_decontamination,
    "op3_line_chunks": op3_line_chunks,
    "op4_near_dup": op4_near_dup,
    "op5_importance": op5_importance,
    "op6_quality_rules": op6_quality_rules,
    "op7_warc_bundles": op7_warc_bundles,
    "op8_katz_lm": op8_katz_lm,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_html_extraction": op10_html_extraction,
    "op11_collocations": op11_collocations,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_knn_join": op13_knn_join,
}

LLM_ORACLE: dict[str, str] = {
    "op7_warc_bundles": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        d AS (
            SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex,
                   min(page_id) OVER (PARTITION BY sha1(payload)) AS first_id
            FROM p),
        bits AS (
            SELECT page_id, payload_bytes, first_id, list_transform(range(0, 32), lambda k: substr(
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + (CAST('0x' || substr(hex, 1 + (5 * k) // 4, 1) AS INTEGER) * 16
                     + CAST('0x' || CASE WHEN (5 * k) // 4 + 2 > 40 THEN '0' ELSE substr(hex, 2 + (5 * k) // 4, 1) END AS INTEGER))
                    // CAST(power(2, 3 - (5 * k) % 4) AS INTEGER) % 32, 1)) AS chars
            FROM d)
        SELECT page_id, payload_bytes, array_to_string(chars, '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM bits""",
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT doc, coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM (SELECT row_number() OVER () AS doc, lang, text FROM documents)),
        w AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
        g AS (
            SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
            FROM (SELECT lang, w, k, unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
        totals AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
        f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 30),
        c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS p FROM f WHERE k >= 2),
        inside AS (
            SELECT lang, array_to_string(list_slice(p, i, i + m - 1), ' ') AS phrase, max(a) AS longer
            FROM (SELECT lang, p, a, k, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k) GROUP BY 1, 2),
        kept AS (
            SELECT c.* FROM c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase WHERE i.longer IS NULL OR 100 * i.longer < 80 * c.a),
        cuts AS (
            SELECT lang, phrase, a, cut, array_to_string(list_slice(p, 1, cut), ' ') AS head, array_to_string(list_slice(p, cut + 1, k), ' ') AS rest
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept)),
        s AS (
            SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f) AS BIGINT) AS score,
                   row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f), cut) AS nth
            FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM s WHERE nth = 1)
        SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000""",
    "op12_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        ids AS (
            SELECT conv_id, conv_id - conv_id % 20 AS base, list_transform(range(0, 8 * strlen(CAST(conv_id AS VARCHAR))), lambda k:
                   CASE WHEN k % 8 = 0 THEN ascii(substr(CAST(conv_id AS VARCHAR), CAST(k // 8 AS INTEGER) + 1, 1)) ELSE 0 END::BIGINT) AS bits
            FROM (SELECT DISTINCT conv_id FROM t)),
        h AS (
            SELECT conv_id, base, xor(list_reduce(list_concat([4294967295::BIGINT], bits), lambda a, x:
                   xor(xor(a, x) // 2, (xor(a, x) % 2) * 3988292384)), 4294967295) % 4 AS h FROM ids),
        r AS (
            SELECT h.conv_id, 0 AS own, t.pos, t.role, t.text FROM h JOIN t ON t.conv_id = h.base AND t.pos < h.h
            UNION ALL
            SELECT h.conv_id, 1, t.pos, t.role, t.text FROM h JOIN t ON t.conv_id = h.conv_id AND t.pos >= h.h),
        s AS (
            SELECT h.conv_id, coalesce(list({'r': r.role, 't': r.text} ORDER BY r.own, r.pos) FILTER (r.pos IS NOT NULL), []) AS turns
            FROM h LEFT JOIN r ON r.conv_id = h.conv_id GROUP BY h.conv_id),
        m AS (
            SELECT conv_id, d, list_slice(turns, 1, d) AS p, d = len(turns) AS ends FROM s, (SELECT unnest(range(0, 100000)) AS d) WHERE d <= len(turns)),
        n AS (
            SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ids FROM m GROUP BY p, d),
        c AS (
            SELECT n.*, (SELECT count(*) FROM n y WHERE y.d = n.d + 1 AND list_slice(y.p, 1, n.d) = n.p) AS n_children,
                   CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(p[d].t, '[^\x20\x09-\x0D]+')) END AS saved FROM n),
        u AS (
            SELECT list_slice(c.p, 1, a.d) AS p, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves
            FROM c JOIN (SELECT unnest(range(0, 100000)) AS d) a ON a.d <= c.d GROUP BY 1)
        SELECT c.conv_id, c.d AS depth, f.conv_id AS parent_conv_id, c.n_convs, c.n_children, CAST(u.leaves AS BIGINT) AS n_leaves,
               CAST(u.saved AS BIGINT) AS saved_tokens, sha256(coalesce(c.ids, '')) AS ends_sha256
        FROM c JOIN u ON u.p = c.p LEFT JOIN n f ON c.d > 0 AND f.d = c.d - 1 AND f.p = list_slice(c.p, 1, c.d - 1)""",
    "op13_knn_join": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(d.v AS DOUBLE[])) AS BIGINT) AS score
            FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
        r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
}
