"""Hybrid search: exact dense top-k and lexical top-k, fused by reciprocal ranks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.functions.text import bm25, matches_all, query_terms, terms
from siltstone.functions.vectors import cosine_distance

CANDIDATES, RRF_K, LIMIT = 30, 60, 10


def filtered(chunks: DataFrame, repo: str | None = None, source_type: str | None = None) -> DataFrame:
    """Both filters where set (an empty string is not); they come before any top-k and reach the scan."""
    for column, value in (("repo", repo), ("source_type", source_type)):
        if value:
            chunks = chunks.filter(F.col(column) == value)
    return chunks


def dense_topk(chunks: DataFrame, query: list[float], k: int = CANDIDATES, id_col: str = "chunk_id") -> DataFrame:
    """(id, distance, rank) of the k least cosine distances, ties by id; rows without an embedding are left out."""
    near = chunks.filter(F.col("embedding").isNotNull()).select(F.col(id_col).alias("id"), cosine_distance(F.col("embedding"), query).alias("distance"))
    return ranked(near.orderBy(F.asc_nulls_last("distance"), "id").limit(k), F.asc_nulls_last("distance"))


def ranked(top: DataFrame, *order) -> DataFrame:
    """Ranks from 1 of at most k rows; the one window over a single partition has k rows."""
    return top.withColumn("rank", F.row_number().over(W.orderBy(*order, "id")))


def lexical_topk(chunks: DataFrame, query: str, k: int = CANDIDATES, id_col: str = "chunk_id", text_col: str = "display_content", terms_col: str | None = None) -> DataFrame:
    """(id, score, rank) of the k best BM25 scores among rows that have every term of the query, ties by id. A query of
    stop words alone finds nothing. Statistics are over the rows given; one row of them comes to the driver."""
    wanted = query_terms(query)
    held = chunks.select(F.col(id_col).alias("id"), (F.col(terms_col) if terms_col else terms(F.col(text_col))).alias("terms"))
    if not wanted:
        return held.filter(F.lit(False)).select("id", F.lit(0.0).alias("score"), F.lit(1).alias("rank"))
    having = [F.count(F.when(F.array_contains("terms", t), 1)).alias(f"t{i}") for i, t in enumerate(wanted)]
    stats = held.agg(F.count("*").alias("n"), F.avg(F.size("terms")).alias("mean"), *having).first()
    score = bm25(F.col("terms"), wanted, stats["n"], stats["mean"] or 0.0, {t: stats[f"t{i}"] for i, t in enumerate(wanted)})
    top = held.filter(matches_all(F.col("terms"), wanted)).select("id", score.alias("score")).orderBy(F.desc("score"), "id").limit(k)
    return ranked(top, F.desc("score"))


def fuse(lists: list[DataFrame], k: int = RRF_K) -> DataFrame:
    """Lists of (id, rank) -> (id, score, first_list, first_rank), score the sum of 1 / (k + rank)."""
    tagged = [x.select("id", "rank", F.lit(i).alias("list")) for i, x in enumerate(lists)]
    every = reduce(DataFrame.unionByName, tagged)
    return every.groupBy("id").agg(F.sum(1.0 / (k + F.col("rank"))).alias("score"), F.min(F.struct("list", "rank")).alias("first")).select("id", "score", F.col("first.list").alias("first_list"), F.col("first.rank").alias("first_rank"))


def search(chunks: DataFrame, query: str, vector: list[float], limit: int = LIMIT, repo: str | None = None, source_type: str | None = None, candidates: int = CANDIDATES) -> DataFrame:
    """The best `limit` chunks with score and place (from 1); equal scores in the order dense list first, then rank.
    The ids of at most 2 * candidates rows are broadcast to fetch the rest of their columns."""
    held = filtered(chunks, repo, source_type)
    fused = fuse([dense_topk(held, vector, candidates), lexical_topk(held, query, candidates)])
    order = (F.desc("score"), "first_list", "first_rank")
    best = fused.orderBy(*order).limit(limit).withColumn("place", F.row_number().over(W.orderBy(*order)))
    shown = held.select("chunk_id", "source_id", "source_type", "repo", "file_path", "symbol_name", "symbol_type", "display_content", "url")
    return shown.join(F.broadcast(best.select(F.col("id").alias("chunk_id"), "score", "place")), "chunk_id").orderBy("place")
