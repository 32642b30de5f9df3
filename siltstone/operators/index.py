"""A layout for search: terms and statistics stored once, postings by term, and vectors by coarse cells.

A search without it splits and filters every text. With it the lexical side reads the postings of the query's terms
only, and the dense side the cells that can hold one of the nearest vectors: a cell is left out when its centre and radius prove
that none of its vectors is near enough, so results are those of the whole table.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import B, K1, query_terms, terms
from siltstone.functions.vectors import cosine_distance, dot, norm
from siltstone.operators.search import CANDIDATES, ranked

#: Files of postings; a query reads those of its terms.
BUCKETS = 64


def term_bucket(term, buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def postings(chunks: DataFrame, id_col: str = "chunk_id", text_col: str = "display_content", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, term, id, n, size): how often each term is in each row, and how many terms the row has."""
    held = chunks.select(F.col(id_col).alias("id"), terms(F.col(text_col)).alias("t"))
    each = held.select("id", F.size("t").alias("size"), F.explode("t").alias("term"))
    return each.groupBy("term", "id", "size").agg(F.count("*").alias("n")).select(term_bucket(F.col("term"), buckets).alias("bucket"), "term", "id", "n", "size")


def statistics(chunks: DataFrame, text_col: str = "display_content") -> DataFrame:
    """One row: how many rows there are and how many terms in all."""
    return chunks.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size(terms(F.col(text_col)))), F.lit(0)).cast("long").alias("terms"))


def write(chunks: DataFrame, path: str, **columns) -> None:
    """Postings partitioned by bucket and sorted by term, so that a query's terms are found by folder and row group, and statistics."""
    found = postings(chunks, **columns)
    found.repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/postings")
    statistics(chunks, columns.get("text_col", "display_content")).write.parquet(f"{path}/statistics")


def lexical_topk(held: DataFrame, stats: DataFrame, query: str, k: int = CANDIDATES, buckets: int = BUCKETS) -> DataFrame:
    """search.lexical_topk() from postings and statistics: (id, score, rank). Reads the postings of the query's terms; a row of
    counts comes to the driver."""
    wanted = query_terms(query)
    found = held.filter(F.col("term").isin(*wanted) & F.col("bucket").isin([r[0] for r in held.sparkSession.range(1).select(F.explode(F.array(*(term_bucket(F.lit(t), buckets) for t in wanted)))).collect()])) if wanted else held.filter(F.lit(False))
    having = {r["term"]: r["rows"] for r in found.groupBy("term").agg(F.count("*").alias("rows")).collect()}  # a row a term of the query
    if not wanted or len(having) < len(wanted):
        return held.filter(F.lit(False)).select("id", F.lit(0.0).alias("score"), F.lit(1).alias("rank"))
    about = stats.first()
    weight = F.create_map(*(F.lit(x) for t in wanted for x in (t, math.log(1 + (about["rows"] - having[t] + 0.5) / (having[t] + 0.5)))))
    mean = max(about["terms"] / about["rows"], 1e-9)
    n = F.col("n").cast("double")
    score = weight[F.col("term")] * n * (K1 + 1) / (n + K1 * ((1 - B) + B * F.col("size") / mean))
    rows = found.groupBy("id").agg(F.sum(score).alias("score"), F.count("*").alias("have")).filter(F.col("have") == len(wanted))
    return ranked(rows.select("id", "score").orderBy(F.desc("score"), "id").limit(k), F.desc("score"))


def unit(v):
    size = norm(v)
    return F.when(size > 0, F.transform(v, lambda x: x / size))


def centres(chunks: DataFrame, cells: int, sample: int = 20_000, rounds: int = 5, seed: int = 3) -> np.ndarray:
    """Centres of about equal cells by spherical k-means over at most `sample` vectors, those of the least hash: the bound of what the driver
    learns from. Every vector is dealt to a cell afterwards, so the sample decides costs only."""
    some = chunks.filter(F.col("embedding").isNotNull()).select(unit(F.col("embedding").cast("array<double>")).alias("v")).filter("v is not null")
    rows = np.array([r[0] for r in some.orderBy(F.xxhash64("v")).limit(sample).collect()])
    if not len(rows):
        return np.zeros((0, 0))
    rng = np.random.default_rng(seed)
    at = rows[rng.choice(len(rows), min(cells, len(rows)), replace=False)]
    for _ in range(rounds):
        own = (rows @ at.T).argmax(axis=1)
        for c in range(len(at)):
            if (own == c).any():
                mean = rows[own == c].mean(axis=0)
                at[c] = mean / max(np.linalg.norm(mean), 1e-12)
    return at


def celled(chunks: DataFrame, at: np.ndarray) -> DataFrame:
    """chunks with the cell of each vector, that of the nearest centre; null without a vector."""
    v = unit(F.col("embedding").cast("array<double>"))
    if not len(at):
        return chunks.withColumn("cell", F.lit(None).cast("int"))
    near = F.array(*(F.struct((-dot(F.col("siltstone_v"), F.array(*map(F.lit, map(float, c))))).alias("d"), F.lit(i).alias("cell")) for i, c in enumerate(at)))
    return chunks.withColumn("siltstone_v", v).withColumn("cell", F.when(F.col("siltstone_v").isNotNull(), F.array_min(near)["cell"])).drop("siltstone_v")


def radii(held: DataFrame, at: np.ndarray) -> dict[int, float]:
    """The widest angle between a cell's centre and its vectors; a row a cell comes to the driver."""
    centre = F.create_map(*(x for i, c in enumerate(at) for x in (F.lit(i), F.array(*map(F.lit, map(float, c))))))
    angle = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), dot(unit(F.col("embedding").cast("array<double>")), centre[F.col("cell")]))))
    return {r["cell"]: r["r"] for r in held.filter("cell is not null").groupBy("cell").agg(F.max(angle).alias("r")).collect()}


def dense_topk(held: DataFrame, at: np.ndarray, radius: dict[int, float], query: list[float], k: int = CANDIDATES, id_col: str = "chunk_id", first: int = 4) -> DataFrame:
    """search.dense_topk() over celled() rows of vectors that are not zero: the `first` nearest cells give a bound for the k-th distance, then
    every cell whose nearest possible vector is within it is searched."""
    q = np.asarray(query, float)
    q = q / max(np.linalg.norm(q), 1e-12)
    angle = {c: math.acos(min(1.0, max(-1.0, float(at[c] @ q)))) for c in radius}
    least = {c: max(0.0, angle[c] - radius[c] - 1e-9) for c in radius}

    def best(cells: list[int]) -> DataFrame:
        near = held.filter(F.col("cell").isin(cells)).select(F.col(id_col).alias("id"), cosine_distance(F.col("embedding"), query).alias("distance"))
        return near.orderBy(F.asc_nulls_last("distance"), "id").limit(k)

    begun = sorted(radius, key=lambda c: angle[c])[:first]
    bound = best(begun).agg(F.count("*").alias("n"), F.max("distance").alias("d")).first() if begun else None
    widest = math.acos(max(-1.0, 1 - bound["d"])) if bound and bound["n"] == k else math.pi
    return ranked(best([c for c in radius if c in begun or least[c] <= widest + 1e-9]), F.asc_nulls_last("distance"))
