"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are split at boundaries that the tokenizer never crosses (see tokenizing.py). The distinct parts of a batch whose length is
not known yet are gathered, dealt into batches of about equal bytes of UTF-8, and each batch goes to the library as a whole;
of its encodings only the lengths are kept.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import by_bytes, kept, table, trimmed, utf8_size
from siltstone.llm.tokenizing import BYTE, LONGEST_KEPT, PIECE, PLAIN, SENTENCES, WORD, WORDS, loaded

OUT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
#: Bytes of the parts that the library encodes together.
BATCH = 1 << 20
#: Lengths of parts that a worker keeps, in each of two generations; longer parts than LONGEST_KEPT are not kept.
LENGTHS_KEPT = 300_000


class BatchCounter:
    """counts(texts): the number of ids of each text, as the library gives them without special tokens."""

    def __init__(self, path: str, batch: int = BATCH, entries: int = LENGTHS_KEPT):
        self.model, self.kind = loaded(path)
        self.batch, self.entries = batch, entries
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.batches = 0

    def encoded(self, parts: list[str]) -> list[int]:
        """Lengths of the parts' encodings, by batches of about equal bytes."""
        out: list[int] = []
        for a, b in by_bytes(parts, self.batch):
            self.batches += 1
            if self.kind == SENTENCES:
                out += map(len, self.model.encode(parts[a:b], num_threads=1))
            else:
                out += map(len, self.model.encode_batch_fast(parts[a:b], add_special_tokens=False))
        return out

    def split(self, text: str) -> list[str]:
        """Parts whose ids, one after the other, are the text's."""
        if self.kind == BYTE:
            if PLAIN.search(text):
                return PIECE.findall(text)
            first, *rest = text.split(" ")
            return [first, *[" " + x for x in rest]]
        return WORD.findall(text) if self.kind == WORDS else [text]

    def counts(self, texts: list[str]) -> list[int]:
        if self.kind not in (BYTE, WORDS):
            return self.encoded(texts)
        parts = [self.split(t) for t in texts]
        known = self.young
        asked = set().union(*parts).difference(known)
        for p in asked & self.old.keys():
            known[p] = self.old[p]
        asked.difference_update(known)
        new = sorted(asked)  # an order of its own, whatever the set's
        found = dict(zip(new, self.encoded(new), strict=True))
        long = {p: n for p, n in found.items() if len(p) > LONGEST_KEPT}
        known.update((p, n) for p, n in found.items() if p not in long)
        get = known.__getitem__ if not long else lambda p: long[p] if p in long else known[p]
        out = [sum(map(get, x)) for x in parts]
        if len(known) > self.entries:
            self.old, self.young = known, {}
        return out


def token_counts(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """One row for each row of df: id_col, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    tokenizer: path of a `.json` (tokenizers) or `.model` (sentencepiece) file, on every executor.
    Batches hold about equal bytes; long texts are split at safe boundaries where the file's kind has any, so a very long text
    costs memory by its parts and its count is exact. Null text counts as empty: 0 bytes, 0 tokens. Null ids stay null, repeated
    rows are kept each, an empty table gives no rows, other columns are not read. No shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is its own, the others are other tasks'
        counter = kept(("lengths", tokenizer), lambda: BatchCounter(tokenizer))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in by_bytes(texts):
                some = [t or "" for t in texts[a:b]]
                yield table(OUT, id=batch.column("id").slice(a, b - a), n_bytes=list(map(utf8_size, some)), n_tokens=counter.counts(some))
        trimmed()

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(count, "id long, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
