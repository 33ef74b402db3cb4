"""The queries of this package, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, crf, extract, langid, licences, linefreq, lm, packing, simhash, topk
from ._shared import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizers' files are."""
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return os.path.join("/opt/tokenizers", name)


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_pages(table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return crf.score_documents(docs, crf.fit(docs, table(spark, sf_dir, "labels")))


def op7_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linefreq.judge(table(spark, sf_dir, "documents")).drop("common")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents")).drop("matches")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_exact_top_k, op2_bpe, op3_language_model, op4_language, op5_main_text, op6_quality, op7_line_frequency, op8_simhash, op9_licences, op10_packing)}


_WORDS = "[^ \\t\\n\\x0b\\x0c\\r]+"


def _line_frequency_sql() -> str:
    return f"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
                     coalesce(CAST(doc_id AS VARCHAR), 'text ' || coalesce(text, '')) AS document FROM documents),
        w AS (SELECT *, regexp_extract_all(text, '{_WORDS}') AS words FROM d),
        windows AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS n
                    FROM (SELECT rid, words, unnest(generate_series(1, len(words) - 2)) AS i FROM w WHERE len(words) > 2) q),
        again AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM windows, (VALUES (0), (1), (2)) t(k) WHERE n > 1 GROUP BY rid),
        lines AS (SELECT rid, host, document, line, len(regexp_extract_all(line, '{_WORDS}')) AS words,
                         regexp_replace(trim(regexp_replace(lower(line), '\\s+', ' ', 'g')), '[0-9]+', '0', 'g') AS norm
                  FROM (SELECT rid, host, document, unnest(string_split(text, chr(10))) AS line FROM d) q WHERE regexp_matches(line, '{_WORDS}')),
        dups AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY rid),
        sizes AS (SELECT host, count(DISTINCT document) AS everything FROM d GROUP BY host),
        common AS (SELECT host, norm FROM lines JOIN sizes USING (host) GROUP BY host, norm, everything
                   HAVING count(DISTINCT document) > {linefreq.LIMIT_LEAST} AND count(DISTINCT document) > {linefreq.LIMIT_SHARE} * everything),
        cut AS (SELECT rid, sum(words) AS removed_words FROM lines JOIN common USING (host, norm) GROUP BY rid),
        m AS (SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
                     length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
                     coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed_words, 0) AS removed_words
              FROM w LEFT JOIN again USING (rid) LEFT JOIN dups USING (rid) LEFT JOIN cut USING (rid))
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
               CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(removed_words AS BIGINT) AS removed_words,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - removed_words >= {linefreq.KEPT_SHARE} * n_words AS kept FROM m"""


def _licences_sql() -> str:
    words = lambda x: "[" + ", ".join(f"'{w}'" for w in x) + "]"
    rows = ", ".join(f"('{t.label}', {words(t.words)}, {t.key[0]}, {words(t.words[slice(*t.key)])}, {str(t.base).lower()})" for t in licences.templates())
    return f"""
        WITH t(label, words, place, key, base) AS (VALUES {rows}),
        d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        p AS (SELECT rid, w, unnest(generate_series(1, len(w))) AS i FROM d),
        f AS (SELECT rid, label, base, t.words, w, i - 1 - place AS start FROM p JOIN t ON p.w[p.i] = t.key[1] WHERE w[i:i + len(key) - 1] = key),
        m AS (SELECT *, list_sum(list_transform(generate_series(1, len(words)), lambda j: CASE WHEN start + j >= 1 AND w[start + j] = words[j] THEN 1 ELSE 0 END)) / len(words) AS share FROM f),
        g AS (SELECT rid, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
                     string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM m WHERE share >= {licences.COVERAGE} GROUP BY rid)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score FROM d LEFT JOIN g USING (rid)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_top_k": """
            WITH v AS (
              SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
              WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
            s AS (
              SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
              FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
            r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
            SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
        "op7_line_frequency": _line_frequency_sql(),
        "op9_licences": _licences_sql(),
    }
