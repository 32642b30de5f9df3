"""Language identification by rank-order profiles of character n-grams.

A text in lower case, with every run of non-letters as one blank, gives n-grams of one to three
characters. A profile is a language's most frequent n-grams in order; a text's distance to it is the
sum, over the text's own most frequent n-grams, of how far each is out of its place, an n-gram that
the profile lacks counting as the profile's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.llm.shared import by_bytes, table

LONGEST = 3
#: N-grams in a language's profile and in a text's own ranking.
PROFILE = 400
TEXT_RANKS = 300
HASHED = 2 << 20
UNKNOWN = "und"

COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
OUT = pa.schema([("id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

_letter: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _letter
    if _letter is None:
        _letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letter


def grams(text: str) -> np.ndarray:
    """The keys of all n-grams of a text: three code points of 21 bits, the last character lowest; a
    text without a letter has none."""
    code = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32).astype(np.int64)
    blank = ~letters()[code]
    if blank.all():
        return np.empty(0, np.int64)
    keep = np.ones(len(code) + 2, bool)
    line = np.full(len(code) + 2, 32, np.int64)
    line[1:-1] = np.where(blank, 32, code)
    keep[1:] = (line[1:] != 32) | (line[:-1] != 32)
    line = line[keep]
    one = line[line != 32]
    two = (line[:-1] << 21) | line[1:]
    three = (two[:-1] << 21) | line[2:]
    return np.concatenate([one, two, three])


def ranked(keys: np.ndarray, most: int) -> np.ndarray:
    """The `most` most frequent keys, those of equal count by key."""
    found, n = np.unique(keys, return_counts=True)
    if len(found) > most:
        edge = np.partition(n, -most)[-most]
        some = n >= edge
        found, n = found[some], n[some]
    return found[np.lexsort((found, -n))][:most]


def profiles(df: DataFrame, lang_col: str = "lang", text_col: str = "text", most: int = PROFILE) -> list[tuple[str, np.ndarray]]:
    """(language, its n-grams in order) from all rows of df with a text and a language, by name.

    Tasks sum their own rows' n-grams before the shuffle, so a language with most of the rows is
    no hot key. What comes to the driver is `most` keys a language. Null texts and languages are left out, an empty text adds
    nothing, repeated rows count each, equal counts are ordered by key, an empty table gives no profile.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def flush(lang: str) -> pa.RecordBatch:
            keys, n = merged(held.pop(lang))
            return table(COUNTS, lang=[lang] * len(keys), gram=keys, n=n)

        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for a, b in by_bytes(texts, HASHED):
                new: dict[str, list] = {}
                for t, lang in zip(texts[a:b], langs[a:b], strict=True):
                    new.setdefault(lang, []).append(grams(t))
                for lang, parts in new.items():
                    keys, n = np.unique(np.concatenate(parts), return_counts=True)
                    held[lang] = [merged([*held.get(lang, []), (keys, n)])]
                for lang in [k for k, v in held.items() if len(v[0][0]) > 500_000]:
                    yield flush(lang)
        for lang in list(held):
            yield flush(lang)

    rows = df.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text is not null")
    total = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = total.withColumn("place", place).filter(F.col("place") <= most).select("lang", "gram", "place").toArrow().to_pandas()
    return [(lang, g.sort_values("place")["gram"].to_numpy()) for lang, g in top.groupby("lang", sort=True)]


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([n for _, n in parts]).astype(np.float64), len(keys)).astype(np.int64)


class Classifier:
    def __init__(self, known: list[tuple[str, np.ndarray]], ranks: int = TEXT_RANKS):
        self.ranks, self.names = ranks, [k for k, _ in known]
        self.keys = np.unique(np.concatenate([g for _, g in known])) if known else np.empty(0, np.int64)
        self.missing = max((len(g) for _, g in known), default=0)
        self.place = np.full((len(self.keys) + 1, len(known)), -1, np.int64)
        for j, (_, g) in enumerate(known):
            self.place[np.searchsorted(self.keys, g), j] = np.arange(len(g))

    def __call__(self, text: str | None) -> tuple[str, float]:
        keys = grams(text) if text else np.empty(0, np.int64)
        if not len(keys) or not self.names:
            return UNKNOWN, 0.0
        own = ranked(keys, self.ranks)
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        at[self.keys[at] != own] = len(self.keys)
        place = self.place[at]
        off = np.where(place < 0, self.missing, np.minimum(np.abs(place - np.arange(len(own))[:, None]), self.missing)).sum(axis=0)
        best = int(off.argmin())  # of equals, the first name
        return self.names[best], 1.0 - float(off[best]) / (self.missing * len(own))


def predict(df: DataFrame, known: list[tuple[str, np.ndarray]], id_col: str = "doc_id", text_col: str = "text", ranks: int = TEXT_RANKS) -> DataFrame:
    """One row for each row of df: id_col, lang_pred, score (1 less the distance, as a share of the largest
    possible one). Null texts and texts without a letter are `und` with score 0, as is every text where
    no profile is known; ties go to the first name; whole texts count, however long; repeated
    rows are kept each, null ids stay, an empty table gives no rows, other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(known, ranks)
        for batch in batches:
            said = [classify(t) for t in batch.column("text").to_pylist()]
            yield table(OUT, id=batch.column("id"), lang_pred=[x for x, _ in said], score=[x for _, x in said])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, lang_pred string, score double").withColumnRenamed("id", id_col)


def remainder(id_col: str, n: int):
    """crc32 of the id as text, modulo n; null for null."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def held_out_languages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5) -> DataFrame:
    """Profiles from the rows whose crc32(id) mod `folds` is not 0 (null ids: none), predictions for all
    rows: id_col, held_out, lang_pred, score."""
    known = profiles(df.filter(remainder(id_col, folds) != 0), lang_col, text_col)
    held = F.coalesce(remainder(id_col, folds) == 0, F.lit(False)).alias("held_out")
    return predict(df, known, id_col, text_col).select(id_col, held, "lang_pred", "score")
