"""Registered queries of the operators: whole tables in, the columns of their contracts out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm import (
    bpe,
    decontaminate,
    divergence,
    jaccard_join,
    licenses,
    line_dedup,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    sharding,
    spelling,
    token_files,
)
from seriesmill.llm.common import table


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.verdicts(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "probability",
    )


#: The tokenizer of the queries, a parameter of the operators.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.personal_data(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", *(f"n_{k}" for k in pii.KINDS), F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.interleave(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_texts(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_chunks(docs, counts=("n_chunks_removed", "n_lines_removed"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_tokens(table(spark, sf_dir, "documents"), TOKENIZER)
    rows = token_files.read_tokens(files)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.license_scan(table(spark, sf_dir, "documents"))
    return rows.withColumn("families", F.array_join("families", ","))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.scores(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


_ASCII_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP9_SQL = f"""
WITH items AS (SELECT item_id, {_ASCII_WORDS} AS w FROM benchmark),
docs AS (SELECT doc_id, {_ASCII_WORDS} AS w FROM documents),
wins AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[s : s + least(10, len(w)) - 1], ' ') AS win
    FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(s) WHERE len(w) > 0),
doc_wins AS (
    SELECT doc_id, size, s, array_to_string(w[s : s + size - 1], ' ') AS win
    FROM (SELECT * FROM docs, (SELECT DISTINCT size FROM wins)), unnest(range(1, len(w) - size + 2)) t(s)),
occ AS (SELECT doc_id, item_id, size, s FROM doc_wins JOIN wins USING (size, win)),
hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM occ, unnest(range(s, s + size)) t(p) GROUP BY doc_id),
found AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS items_sha256
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)"""


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH docs AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
kept AS (
    SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM docs)
    GROUP BY lang, term HAVING count(*) >= 30),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
    SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM docs)
    JOIN kept USING (lang, term) GROUP BY ALL),
wide AS (
    SELECT lang, source, term, coalesce(n, 0) AS n
    FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
shares AS (
    SELECT lang, source, term, n,
           1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source)::HUGEINT + 5 * v) AS p
    FROM wide JOIN vocabulary USING (lang)),
whole AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang)::HUGEINT + 5 * v) AS q
    FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM wide GROUP BY lang, term) JOIN vocabulary USING (lang)),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(abs(x.p - y.p)) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    WHERE x.term IS NULL OR y.term IS NOT NULL
    GROUP BY ALL),
most AS (
    SELECT lang, source, 'term' AS part, term AS item, p - q AS value
    FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT lang, source, part, item, coalesce(value, 0) AS value FROM pairs UNION ALL SELECT * FROM most))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), TOKENIZER)
    return bpe.decode(encoded, TOKENIZER).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_packing": op2_packing,
    "op3_sharding": op3_sharding,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_line_dedup": op5_line_dedup,
    "op6_token_files": op6_token_files,
    "op7_license_scan": op7_license_scan,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_decontamination": op9_decontamination,
    "op10_quality_rules": op10_quality_rules,
    "op11_source_divergence": op11_source_divergence,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_bpe_round_trip": op13_bpe_round_trip,
}

#: SQL for the queries that it can express on whole tables.
SQL: dict[str, str] = {
    "op9_decontamination": OP9_SQL,
    "op11_source_divergence": OP11_SQL,
}
