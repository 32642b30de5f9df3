"""The queries of the operators over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import chunk_reuse, classifier, language_id, order_minhash, packing, perplexity, simhash, substring, token_counts, warc


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality_rules(documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op3_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_reuse.encode_decode_digests(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.held_out_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicate_digests(documents(spark, sf_dir))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited_fingerprints(documents(spark, sf_dir))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.held_out_languages(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_token_counts, op3_chunk_reuse, op4_quality_classifier, op5_substring_dedup, op6_simhash, op7_packing, op8_order_minhash, op9_warc, op10_language_id)}


#: Of every word, whether a window of 50 words that starts in a document with a smaller id covers it.
SUBSTRING_SQL = r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
runs AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM split WHERE len(w) >= 50),
keyed AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h FROM runs),
hits AS (SELECT doc_id, p FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first FROM keyed) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM hits),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""

#: The digest's hex digits as bits, five of them a base32 letter.
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS keep FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][1 + strpos('0123456789abcdef', sha[i]) - 1]), '') AS bits FROM k)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda j: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + 16 * CAST(bits[5 * j + 1] AS INT) + 8 * CAST(bits[5 * j + 2] AS INT) + 4 * CAST(bits[5 * j + 3] AS INT) + 2 * CAST(bits[5 * j + 4] AS INT) + CAST(bits[5 * j + 5] AS INT)]), '') AS payload_digest,
    CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = keep THEN NULL ELSE keep END AS refers_to
FROM b
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_substring_dedup": SUBSTRING_SQL, "op9_warc": WARC_SQL}
