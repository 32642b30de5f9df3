"""Embedding through a pluggable service, with retries, and halves where a text is refused."""

from __future__ import annotations

import hashlib
import json
import math
import random
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.runtime import modest

BATCH, DIMENSIONS, RETRIES, DEEPEST, LEAST = 128, 1024, 5, 4, 200
PASSAGE, QUERY = "nl2code.passage", "nl2code.query"
Vector = list[float]


class RateLimited(Exception):
    """The service asks to come again later."""


class Embedder(Protocol):
    def __call__(self, texts: list[str], task: str = PASSAGE) -> list[Vector]: ...


class HashEmbedder:
    """Unit vectors from hashed words, the same everywhere and without a service."""

    def __init__(self, dimensions: int = 64):
        self.dimensions = dimensions

    def __call__(self, texts: list[str], task: str = PASSAGE) -> list[Vector]:
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> Vector:
        v = [0.0] * self.dimensions
        for w in re.findall(r"[a-z0-9]+", text.lower()):
            h = hashlib.md5(w.encode(), usedforsecurity=False).hexdigest()
            v[int(h[:8], 16) % self.dimensions] += 1.0 if int(h[8], 16) >= 8 else -1.0
        size = math.sqrt(sum(x * x for x in v)) or 1.0
        return [x / size for x in v]


class HttpEmbedder:
    """A service that takes {model, input, task, dimensions} and gives {data: [{index, embedding}]}."""

    def __init__(self, url: str, key: str, model: str, dimensions: int = DIMENSIONS, post: Callable[[str, dict, bytes], tuple[int, bytes]] | None = None):
        self.url, self.key, self.model, self.dimensions, self.post = url, key, model, dimensions, post or self._post

    @staticmethod
    def _post(url: str, headers: dict, body: bytes) -> tuple[int, bytes]:
        try:
            with urllib.request.urlopen(urllib.request.Request(url, body, headers, method="POST"), timeout=120) as r:
                return r.status, r.read()
        except urllib.error.HTTPError as e:
            return e.code, e.read()

    def __call__(self, texts: list[str], task: str = PASSAGE) -> list[Vector]:
        body = json.dumps({"model": self.model, "input": texts, "task": task, "dimensions": self.dimensions}).encode()
        status, said = self.post(self.url, {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"}, body)
        if status == 429:
            raise RateLimited(said[:200])
        if not 200 <= status < 300:
            raise OSError(f"embedding failed with {status}: {said[:200]!r}")
        return [x["embedding"] for x in sorted(json.loads(said)["data"], key=lambda x: x["index"])]


def patiently(call: Callable[[], list[Vector]], sleep: Callable[[float], None] = time.sleep, retries: int = RETRIES) -> list[Vector]:
    """call(), again after a growing pause while it is rate-limited; other errors pass at once."""
    for attempt in range(retries + 1):
        try:
            return call()
        except RateLimited:
            if attempt == retries:
                raise
            sleep(2.0**attempt + 0.5 * random.random())
    raise AssertionError


def split_at(text: str) -> int:
    """The first line end from the middle on, else the middle."""
    middle = len(text) // 2
    at = text.find("\n", middle)
    return middle if at < 0 else at


def mean_of(a: Vector, b: Vector, weight_a: int, weight_b: int) -> Vector:
    v = [(x * weight_a + y * weight_b) / (weight_a + weight_b) for x, y in zip(a, b, strict=True)]
    size = math.sqrt(sum(x * x for x in v)) or 1.0
    return [x / size for x in v]


def embed_one(embedder: Embedder, text: str, depth: int = 0, sleep: Callable[[float], None] = time.sleep) -> Vector | None:
    """The vector of a text; where it is refused, of its halves by length; None where those are refused too."""
    try:
        return patiently(lambda: embedder([text]), sleep)[0]
    except Exception:
        if depth >= DEEPEST or len(text) < LEAST:
            return None
        at = split_at(text)
        left, right = (embed_one(embedder, t, depth + 1, sleep) for t in (text[:at], text[at:]))
        if left is None or right is None:
            return right if left is None else left
        return mean_of(left, right, at, len(text) - at)


def embed_texts(embedder: Embedder, texts: list[str], batch: int = BATCH, sleep: Callable[[float], None] = time.sleep) -> list[Vector | None]:
    """A vector or None for each text, in order."""
    out: list[Vector | None] = []
    for a in range(0, len(texts), batch):
        some = texts[a : a + batch]
        try:
            out += patiently(lambda some=some: embedder(some), sleep)
        except Exception:
            out += [embed_one(embedder, t, sleep=sleep) for t in some]
    return out


def embedded(chunks: DataFrame, embedder: Embedder, text_col: str = "content", streams: int | None = None) -> DataFrame:
    """chunks with an embedding column, null where the text could not be embedded. streams: how many partitions ask the service at once."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = iter(embed_texts(embedder, [t for t in texts if t is not None]))
            yield pd.Series([None if t is None else next(found) for t in texts], dtype=object)

    modest(chunks.sparkSession)
    return (chunks.coalesce(streams) if streams else chunks).withColumn("embedding", embed(F.col(text_col)))
