"""One registered query per training-data operator, over whole ``documents`` tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dimwright.llm.common import documents
from dimwright.llm.exact_dedup import exact_duplicates
from dimwright.llm.language_id import identify_languages
from dimwright.llm.line_dedup import dedup_lines
from dimwright.llm.minhash_dedup import near_duplicates
from dimwright.llm.packing import pack_documents
from dimwright.llm.pii import personal_data
from dimwright.llm.quality_classifier import classify_quality
from dimwright.llm.quality_rules import quality
from dimwright.llm.sentencepiece_bpe import encode_decode
from dimwright.llm.sharding import shard_rows
from dimwright.llm.spelling_variants import spelling_variants
from dimwright.llm.substring_dedup import remove_repeats
from dimwright.llm.token_alignment import align_tokenizers

#: Vocabulary files of the byte-pair tokenizer: definition, ranks, and the pattern that splits texts.
BYTE_BPE = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(documents(spark, sf_dir), PIECE_BPE)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir)).drop("keep_bitmap")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir)).drop("locator")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(documents(spark, sf_dir))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), BYTE_BPE)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir)).drop("found")


def op8_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(documents(spark, sf_dir))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(documents(spark, sf_dir), BYTE_BPE[0], PIECE_BPE)


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece_bpe, op2_line_dedup, op3_exact_dedup, op4_language_id, op5_substring_dedup,
        op6_best_fit_packing, op7_pii, op8_feistel_sharding, op9_minhash_dedup, op10_quality_rules,
        op11_token_alignment, op12_quality_classifier, op13_spelling_variants,
    )
}

#: DuckDB SQL where it can express the operator; the others are tested against brute force.
SQL: dict[str, str] = {
    "op2_line_dedup": """
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines),
        owners AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE owner < doc_id) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                               FILTER (WHERE owner IS NULL OR owner >= doc_id), '')) AS kept_sha256
        FROM keyed LEFT JOIN owners USING (key)
        GROUP BY doc_id""",
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op5_substring_dedup": r"""
        WITH texts AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS pos FROM texts),
        windows AS (
            SELECT doc_id, pos, array_to_string(list_slice(words, pos, pos + 19), ' ') AS win FROM starts),
        ranked AS (
            SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS place FROM windows),
        gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM ranked WHERE place > 1),
        single AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM texts),
        judged AS (
            SELECT s.doc_id, s.word, s.pos, g.pos IS NOT NULL AS lost
            FROM single s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.pos = g.pos)
        SELECT t.doc_id, len(t.words)::BIGINT AS n_words, count(*) FILTER (WHERE lost) AS n_removed,
               sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
        FROM texts t LEFT JOIN judged j ON t.doc_id = j.doc_id
        GROUP BY t.doc_id, t.words""",
}
