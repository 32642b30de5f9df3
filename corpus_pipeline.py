"""From documents to packed sequences: quality rules, quality classifier, near-duplicates, repeated
passages, packing. Each stage takes what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import classifier, near_copies, packing, perplexity, substring
from siltstone.llm.entries import tokenizer_path
from siltstone.llm.shared import settled
from siltstone.runtime import modest

#: Entries of the caches that packing's encoders keep, fewer than by default for the same reason.
CACHED = 40_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Row by row: null and short texts go, rows of one id or of none are judged each, equal texts alike; an empty table stays empty."""
    modest(spark)
    return perplexity.passing(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of the stage's own documents; the fold held out of training is scored too. Row by row, as above."""
    modest(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(classifier.remainder("doc_id", 3) != 1)
    return classifier.good(docs, classifier.train(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """By the general rule, five-word shingles and a similarity of 0.8; op6_simhash has a contract of its own. SimHash links are checked
    exactly, an exact join adds those that fingerprints miss. One row of each class stays, that of the smallest id; null ids come after all others."""
    modest(docs.sparkSession)
    return near_copies.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose their repeated passages; n_chars follows; a text of which nothing is left stays, empty."""
    modest(docs.sparkSession)
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    found = substring.deduplicate(docs, carry=carry)
    column = {"text": F.col("kept"), **({"n_chars": F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))} if "n_chars" in carry else {})}
    return found.select(*(column.get(c, F.col(c)).alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece; null texts are packed as empty ones, repeated rows each."""
    modest(docs.sparkSession)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), entries=CACHED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("packing", pack),
]

#: The perplexity bands, the classifier and XXH64 have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
