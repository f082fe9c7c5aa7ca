"""One query per operator over the driver tables, and SQL where it can say the same."""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnloom.llm import (
    alignment,
    filter_audit,
    id_files,
    licenses,
    line_dedup,
    neighbours,
    packing,
    passages,
    pieces,
    quality,
    repeats,
    simhash,
    top_k,
)
from vulnloom.llm.common import documents
from vulnloom.session import work_path

WORD_BPE, BYTE_BPE, PIECES = map(public_tokenizers.path, ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
# The base phrases of op10 and their labels. The operator's own phrases are looked for as well.
BASE_PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]


def _digest(found: DataFrame, *more: F.Column) -> DataFrame:
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"), *more)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(repeats.deduplicated(documents(spark, sf_dir)))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), WORD_BPE)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(documents(spark, sf_dir), PIECES)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "ids")
    id_files.write_ids(documents(spark, sf_dir), path, BYTE_BPE)
    return id_files.document_index(spark, path)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    like = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["like"]))).alias("like")
    return _digest(passages.deduplicated(documents(spark, sf_dir)), like)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir), phrases=BASE_PHRASES)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicated(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), BYTE_BPE, PIECES)


QUERIES = {
    "op1_suffix_array_dedup": op1,
    "op2_best_fit_packing": op2,
    "op3_exact_top_k": op3,
    "op4_sentence_pieces": op4,
    "op5_id_files": op5,
    "op6_simhash_near_dedup": op6,
    "op7_substring_dedup": op7,
    "op8_nearest_neighbours": op8,
    "op9_quality_classifier": op9,
    "op10_license_scan": op10,
    "op11_filter_audit": op11,
    "op12_line_dedup": op12,
    "op13_tokenizer_alignment": op13,
}

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _places(phrases: list[tuple[str, str]]) -> str:
    """SQL for the phrases of every document, one row per place."""
    parts = []
    for phrase, label in phrases:
        own = phrase.split()
        parts.append(f"SELECT doc_id, i - 1 AS place, '{label}' AS label FROM "
                     f"(SELECT doc_id, w, unnest(range(1, len(w) - {len(own) - 2})) AS i FROM words) "
                     f"WHERE w[i:i + {len(own) - 1}] = {own}")
    return " UNION ALL ".join(parts)


def _templates() -> str:
    """SQL values of the templates: number, label, distinct words, length of the runs to look in."""
    rows = []
    for i, (label, text) in enumerate(licenses.NOTICES):
        words = re.findall("[a-z0-9]+", text.lower())
        rows.append(f"({i}, '{label}', {sorted(set(words))}, {licenses.reach(len(words))})")
    return ", ".join(rows)


_KEYS = (r"translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), "
         "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
_ORDERS = ", ".join(f"('{order}')" for order in filter_audit.ORDERS)

ORACLES = {
    "op3_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q FROM embeddings
            WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
            vec_id, score
        FROM scored QUALIFY rank <= 20""",
    "op10_license_scan": rf"""
        WITH words AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{_WORDS}') AS w FROM documents),
        places AS ({_places(BASE_PHRASES)}),
        base AS (
            SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels
            FROM places GROUP BY doc_id
        ),
        general AS ({_places(licenses.PHRASES)}),
        phrased AS (
            SELECT doc_id, count(*) AS n_phrases, min(place) AS first_phrase, max(place) AS last_phrase, list(DISTINCT label) AS labels
            FROM general GROUP BY doc_id
        ),
        templates AS (SELECT * FROM (VALUES {_templates()}) t(i, label, t, reach)),
        blocks AS (
            SELECT doc_id, reach, list_distinct(w[s + 1:s + 2 * reach]) AS b
            FROM (SELECT doc_id, w, reach, unnest(range(0, greatest(len(w) - reach, 1), reach)) AS s
                  FROM words, (SELECT DISTINCT reach FROM templates))
        ),
        held AS (
            SELECT doc_id, label, len(list_intersect(b, t)) / len(t) AS share
            FROM blocks JOIN templates USING (reach)
            WHERE len(list_intersect(b, t)) >= ceil(round({licenses.THRESHOLD} * len(t), 9))
        ),
        more AS (SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS share FROM held GROUP BY doc_id)
        SELECT doc_id, len(words.w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
            array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
            array_to_string(list_sort(list_distinct(list_concat(list_concat(coalesce(base.labels, []), coalesce(phrased.labels, [])),
                coalesce(more.labels, [])))), ',') AS labels,
            CASE WHEN n_base > 0 OR n_phrases > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score,
            coalesce(n_phrases, 0) AS n_phrases, first_phrase, last_phrase,
            array_to_string(list_sort(coalesce(phrased.labels, [])), ',') AS phrase_labels
        FROM words LEFT JOIN base USING (doc_id) LEFT JOIN phrased USING (doc_id) LEFT JOIN more USING (doc_id)""",
    "op11_filter_audit": rf"""
        WITH d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
        marks AS (SELECT doc_id, max((quality = 1)::int) AS good, max((toxic = 1)::int) AS toxic FROM labels GROUP BY doc_id),
        failing AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
                || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
                || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 'C' ELSE '' END
                || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                || CASE WHEN d.doc_id > first_id THEN 'E' ELSE '' END AS fails
            FROM d JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)
        ), cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, fails),
        steps AS (
            SELECT o AS filter_order, s::int AS step, substr(o, s, 1) AS own, substr(o, 1, s - 1) AS before
            FROM (VALUES {_ORDERS}) orders(o), range(1, 6) places(s)
        ), judged AS (
            SELECT *, contains(fails, own) AS hit, translate(fails, before, '') <> fails AS gone FROM cells, steps
        ), measured AS (
            SELECT part, filter_order, step, own,
                sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept,
                sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
                sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant,
                sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
                sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost,
                sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
            FROM judged GROUP BY part, filter_order, step, own
        )
        SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
            unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
            (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
        FROM measured""",
    "op12_line_dedup": rf"""
        WITH lines AS (
            SELECT doc_id, nth, line, {_KEYS} AS k
            FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nth FROM documents)
        ), repeats AS (
            SELECT k, min(doc_id) AS first_id FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (doc_id > first_id) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (first_id IS NULL OR doc_id = first_id), '')) AS kept_sha256
        FROM lines LEFT JOIN repeats USING (k) GROUP BY doc_id""",
}
