"""Quality classifier: random-indexing vectors pooled per document, then a small network.

Tokens are runs of letters, of digits, or of one and the same other character. Each has a word (its
bytes in lower case) and a shape (case pattern, kind of character, whether it repeats the token before).
A word or shape has a sparse ternary index vector given by its hash; its own vector is the sum
of the index vectors of its neighbours, over all documents. Vectors live in a table of BUCKETS rows
of DIMS sums, a size that no corpus changes. A document is the mean of its words' vectors, rare ones
weighing more, beside the mean of its shapes' vectors. A two-layer network in numpy scores it; a
temperature fitted on rows that the network did not learn from calibrates the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.shared import by_bytes, free_name, mixed, settled, table, tidy, trimmed, word_hashes

BUCKETS, SHAPES, DIMS = 1 << 13, 64, 64
REACH = 2
#: Labelled rows that the network may learn from, those of the least hash of their id: the bound of the sample.
MOST_LABELS = 20_000
RARE = 1e-3
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 256, 3e-3, 1e-4
HASHED = 1 << 18
DIM_NAMES = [f"d{i}" for i in range(DIMS)]

TABLE = pa.schema([("bucket", pa.int32()), ("n", pa.int64()), *((k, pa.int64()) for k in DIM_NAMES)])
FEATURES = pa.schema([("label", pa.int32()), ("fold", pa.int64()), ("x", pa.list_(pa.float32()))])

REPEATED = 5
_kind = np.full(256, 3, np.int8)
_kind[[0x20, *range(0x09, 0x0E)]] = 0
_kind[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_kind[[*range(0x30, 0x3A)]] = 2
_low = np.arange(256, dtype=np.uint8)
_low[0x41:0x5B] += 32


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each token's word hash and shape, and the number of tokens before each text, and all."""
    data = [t.encode() if t else b"" for t in texts]
    raw = np.frombuffer(b"\n".join(data), np.uint8)
    first = np.cumsum([0, *(len(d) + 1 for d in data)])
    kind = _kind[raw]
    edge = np.ones(len(raw) + 1, bool)
    edge[1:-1] = (kind[1:] != kind[:-1]) | ((kind[1:] == 3) & (raw[1:] != raw[:-1]))
    places = np.flatnonzero(edge)
    starts, ends = places[:-1], places[1:]
    solid = kind[starts] > 0 if len(raw) else np.zeros(0, bool)
    starts, ends = starts[solid], ends[solid]
    words = word_hashes(_low[raw], starts, ends)
    upper = np.concatenate([[0], np.cumsum((raw >= 0x41) & (raw < 0x5B))])
    size, caps, k, byte = ends - starts, upper[ends] - upper[starts], kind[starts], raw[starts].astype(np.int64)
    shape = np.select(
        [k == 2, k == 3, caps == 0, (caps == 1) & (upper[np.minimum(starts + 1, len(raw))] > upper[starts]), 5 * caps >= 3 * size],
        [4, np.where(size == 1, 8 + byte % 28, 36 + byte % 28), 0, 1, 2], 3,
    )
    at = np.searchsorted(starts, first)
    text = np.repeat(np.arange(len(texts)), np.diff(at))
    for back in (1, 2):  # the same letters as the token before, or before one other character
        same = (k[back:] == 1) & (words[back:] == words[:-back]) & (text[back:] == text[:-back])
        shape[back:][same] = REPEATED
    return words, shape, at


def buckets(words: np.ndarray) -> np.ndarray:
    return (SHAPES + (words >> np.uint64(20)) % np.uint64(BUCKETS - SHAPES)).astype(np.int64)


def add_contexts(sums: np.ndarray, rows: np.ndarray, hashes: np.ndarray, text: np.ndarray) -> None:
    """Adds to each row the index vectors of its neighbours: two signed places each."""
    for step in range(1, REACH + 1):
        same = np.flatnonzero(text[step:] == text[:-step])
        for a, b in ((same, same + step), (same + step, same)):
            h = mixed(hashes[b] + np.uint64(step if a is same else 64 + step))
            for shift in (0, 16):
                sign = np.where((h >> np.uint64(shift + 15)) & np.uint64(1), 1.0, -1.0)
                cell = rows[a] * DIMS + ((h >> np.uint64(shift)) % np.uint64(DIMS)).astype(np.int64)
                sums += np.bincount(cell, sign, len(sums))


def vectors(df: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Weighted unit vectors of all buckets and the weights, from every text of df. Tasks add up their
    own tables; Spark adds the tables by bucket; BUCKETS rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros(BUCKETS * DIMS), np.zeros(BUCKETS)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in by_bytes(texts, HASHED):
                words, shape, at = tokens(texts[a:b])
                text = np.repeat(np.arange(b - a), np.diff(at))
                rows = buckets(words)
                add_contexts(sums, rows, words, text)
                add_contexts(sums, shape, mixed(shape.astype(np.uint64) + np.uint64(1)), text)
                n += np.bincount(rows, minlength=BUCKETS) + np.bincount(shape, minlength=BUCKETS)
        some = np.flatnonzero(n)
        grid = sums.reshape(BUCKETS, DIMS)[some].astype(np.int64)
        yield table(TABLE, bucket=some.astype(np.int32), n=n[some].astype(np.int64), **{k: np.ascontiguousarray(grid[:, i]) for i, k in enumerate(DIM_NAMES)})

    rows = df.select(F.col(text_col).alias("text")).filter("text is not null")
    parts = rows.mapInArrow(tidy(run), "bucket int, n long, " + ", ".join(f"{k} long" for k in DIM_NAMES))
    got = parts.groupBy("bucket").agg(*(F.sum(k).alias(k) for k in ("n", *DIM_NAMES))).toArrow()
    where = got.column("bucket").to_numpy()
    v, n = np.zeros((BUCKETS, DIMS)), np.zeros(BUCKETS)
    v[where] = np.stack([got.column(k).to_numpy() for k in DIM_NAMES], axis=1) if len(where) else 0
    n[where] = got.column("n").to_numpy()
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1.0)
    share = n / max(n[SHAPES:].sum(), 1.0)
    weight = RARE / (RARE + share)
    weight[:SHAPES] = 1.0
    return (v * weight[:, None]).astype(np.float32), weight.astype(np.float32)


def pooled(texts: list[str | None], v: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """One row of 2 * DIMS for each text; zeros for a text without tokens. v: vectors times weights."""
    words, shape, at = tokens(texts)
    out = np.zeros((len(texts), 2 * DIMS), np.float32)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        rows, starts = buckets(words), at[some]
        w = weight[rows]
        total = np.add.reduceat(w, starts)[:, None]
        out[some, :DIMS] = np.add.reduceat(v[rows], starts, axis=0) / total
        kinds = np.bincount(np.repeat(np.arange(len(texts)), np.diff(at)) * SHAPES + shape, minlength=len(texts) * SHAPES).reshape(-1, SHAPES)
        out[:, DIMS:] = (kinds / np.maximum(kinds.sum(axis=1, keepdims=True), 1)).astype(np.float32) @ v[:SHAPES]
    return out


class Network:
    """x -> tanh layer -> logit, on standardised features. fit() takes labels 0 and 1."""

    def __init__(self, seed: int = 7):
        self.seed, self.temperature, self.constant = seed, 1.0, None

    def fit(self, x: np.ndarray, y: np.ndarray, held: np.ndarray) -> Network:
        """Learns from rows that are not held, then fits the temperature on those that are. With one
        label only, or none, every score is that label (0.5 for none)."""
        learn = ~held
        if len(np.unique(y[learn])) < 2:
            self.constant = float(y[learn].mean()) if learn.any() else 0.5
            return self
        rng = np.random.default_rng(self.seed)
        self.mean, self.scale = x[learn].mean(axis=0), x[learn].std(axis=0) + 1e-6
        z, t = (x[learn] - self.mean) / self.scale, y[learn].astype(np.float64)
        p = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        m, s, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(z))
            for a in range(0, len(z), BATCH):
                i = order[a : a + BATCH]
                h = np.tanh(z[i] @ p[0] + p[1])
                d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - t[i]) / len(i)
                dh = np.outer(d, p[2]) * (1 - h * h)
                step += 1
                for k, g in enumerate((z[i].T @ dh + DECAY * p[0], dh.sum(axis=0), h.T @ d + DECAY * p[2], d.sum(keepdims=True))):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    p[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
        self.weights = p
        if len(np.unique(y[held])) == 2:
            logit, t = self.logit(x[held]), y[held]
            grid = np.exp(np.linspace(np.log(0.25), np.log(8), 120))
            loss = [np.logaddexp(0, np.where(t == 1, -logit, logit) / c).mean() for c in grid]
            self.temperature = float(grid[int(np.argmin(loss))])
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return np.tanh(z @ self.weights[0] + self.weights[1]) @ self.weights[2] + self.weights[3]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -60, 60)))


def remainder(id_col: str, n: int):
    """crc32 of the id as text, modulo n; null for null."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def train(df: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", most_labels: int = MOST_LABELS) -> tuple[np.ndarray, np.ndarray, Network]:
    """Vectors from all of df, the network from at most `most_labels` rows of labels (0 or 1; others and
    nulls are left out), a fifth of which fit the temperature."""
    v, weight = vectors(df, text_col)
    order = F.xxhash64(F.col(id_col))
    chosen = labels.select(id_col, F.col(label_col).cast("int").alias("label")).filter(F.col("label").isin(0, 1) & F.col(id_col).isNotNull())
    chosen = chosen.withColumn("order", order).orderBy("order", id_col, "label").limit(most_labels)
    chosen = settled(chosen.select(F.col(id_col).alias("label_id"), "label", F.pmod(F.shiftright("order", 8), F.lit(5)).alias("fold")), "labels")
    sent = df.sparkSession.sparkContext.broadcast((v, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in by_bytes(texts, HASHED):
                x = pooled(texts[a:b], *sent.value)
                yield table(FEATURES, label=batch.column("label").slice(a, b - a), fold=batch.column("fold").slice(a, b - a), x=list(x))

    # at most most_labels rows of 20 bytes are broadcast
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("label_id")).select("text", "label", "fold")
    got = settled(rows.mapInArrow(tidy(run), "label int, fold long, x array<float>"), "features").toArrow()
    x = np.array(got.column("x").to_pylist(), np.float32).reshape(-1, 2 * DIMS)
    y, fold = got.column("label").to_numpy(), got.column("fold").to_numpy()
    at = np.lexsort((x[:, 0], y, fold)) if len(y) else np.empty(0, int)  # whatever order the tasks ended in
    return v, weight, Network().fit(x[at].astype(np.float64), y[at], fold[at] == 0)


def score_of(spark: SparkSession, text: Column, model: tuple[np.ndarray, np.ndarray, Network]) -> Column:
    """The score of a text as a column. It counts as not deterministic only so that a filter on it stays
    above it and no text is scored twice."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def said(text: pa.Array) -> pa.Array:
        v, weight, network = sent.value
        texts = text.to_pylist()
        parts = [network(pooled(texts[a:b], v, weight).astype(np.float64)) for a, b in by_bytes(texts, HASHED)]
        trimmed()
        return pa.array(np.concatenate([np.empty(0), *parts]), pa.float64())

    return said.asNondeterministic()(text)


def score(df: DataFrame, model: tuple[np.ndarray, np.ndarray, Network], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: id_col, score from 0 to 1 (label 1 likelier), predicted (1 from 0.5 on).

    The score depends on the text alone. Null and empty texts have the features of no token and are
    scored like any other; null ids stay, repeated rows count each, equal texts score alike, an
    empty table gives no rows, other columns are not read. Whole texts count. No shuffle.
    """
    scored = df.select(F.col(id_col).cast("long").alias(id_col), score_of(df.sparkSession, F.col(text_col), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def good(df: DataFrame, model: tuple[np.ndarray, np.ndarray, Network], text_col: str = "text") -> DataFrame:
    """The rows of df, with all their columns, that score() predicts to be of label 1. No shuffle, no join."""
    name = free_name(df, "siltstone_score")
    return df.withColumn(name, score_of(df.sparkSession, F.col(text_col), model)).filter(F.col(name) >= 0.5).select(*df.columns)


def held_out_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Learns from labels of rows whose crc32(id) mod 3 is not 1, scores all rows of df: id_col,
    held_out, score, predicted. Null ids are not held out and never label a row; a label of a repeated id counts for each of its rows;
    otherwise as score() and train()."""
    model = train(df, labels.filter(remainder(id_col, 3) != 1), label_col, id_col, text_col)
    held = F.coalesce(remainder(id_col, 3) == 1, F.lit(False)).alias("held_out")
    return score(df, model, id_col, text_col).select(id_col, held, "score", "predicted")
