"""BPE encoding and decoding with reuse of content-defined chunks.

A text is cut where the top bits of a hash rolled over 8 bytes are zero, so a passage found in two documents is cut alike in both.
A chunk is encoded once a worker while it is kept. Where two chunks meet, a window that reaches from within
the one into the other is encoded anew, and must agree with both: its first ids must be the left chunk's from the window's
begin to that chunk's last seam, and its last ids the right chunk's from that chunk's first seam to the window's end. Where they do not
agree, both chunks are given up and the window grows over them to their neighbours, until every join agrees or the
window is the whole text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import by_bytes, kept, table, trimmed
from siltstone.llm.tokenizing import PieceEncoder

#: A chunk ends where the top bits of a hash rolled over 8 bytes are all zero.
CHUNK_BITS = 10
SHORTEST, LONGEST = 256, 8192
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of chunk texts and ids that a worker keeps for later documents.
KEPT_BYTES = 48 << 20
#: Where encoding always starts anew: before ASCII white space that follows a printable ASCII character.
SEAM = re.compile(rb"(?<=[!-~])[ \t-\r]")

OUT = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.large_binary())])
DIGEST = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("n_chunks", pa.int64()), ("n_reused", pa.int64())])


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of data, the last one its length. Which places qualify depends on the
    8 bytes around them alone, so a passage found in two documents is cut alike in both."""
    n = len(data)
    if n <= SHORTEST:
        return [n]
    raw = np.frombuffer(data, np.uint8)
    hit = []
    for shift in range(8):
        k = (n - shift) // 8
        if k > 0:
            h = np.frombuffer(data, "<u8", k, shift) * MULTIPLIER
            hit.append(np.flatnonzero(h >> np.uint64(64 - CHUNK_BITS) == 0) * 8 + shift + 8)
    at = np.sort(np.concatenate(hit))
    at = at[at < n]
    at = at[(raw[at] & 0xC0) != 0x80]  # between characters
    out, last = [], 0
    for p in at.tolist():
        while p - last > LONGEST:
            last = _between(raw, last + LONGEST)
            out.append(last)
        if p - last >= SHORTEST:
            out.append(p)
            last = p
    while n - last > LONGEST:
        last = _between(raw, last + LONGEST)
        out.append(last)
    return [*out, n]


def _between(raw: np.ndarray, p: int) -> int:
    while raw[p] & 0xC0 == 0x80:
        p -= 1
    return p


class Chunk:
    """A chunk encoded by itself. first, last: its outermost seams but one; before, after: ids up to them. The margins lie between
    them and the seams outside: head ends and tail begins where a window does. joins: whether it has all of these."""

    __slots__ = ("after", "before", "data", "head", "head_ids", "joins", "raw", "tail", "tail_ids")

    def __init__(self, data: bytes, raw: bytes, sizes: np.ndarray):
        self.data, self.raw, self.joins = data, raw, False
        seams = [m.start() for m in SEAM.finditer(data)] if len(data) <= 4 * SHORTEST else [*_some_seams(data, 0, 2), *_some_seams(data, -1, 2)]
        if len(seams) < 2:
            return
        ends = np.concatenate([[0], np.cumsum(sizes[np.frombuffer(raw, "<u4")])])
        first, second, last, later = seams[0], seams[1], seams[-2], seams[-1]
        at = np.searchsorted(ends, (first, second, last, later)).tolist()
        if any(ends[i] != x for i, x in zip(at, (first, second, last, later), strict=True)):
            return  # this chunk's own ids do not end at its seams
        # a window that ends at the second seam has the ids from the first to the second; one that begins at the last but one, those to the last
        self.joins, self.head, self.tail = True, data[:second], data[last:]
        self.before, self.head_ids = 4 * at[0], raw[4 * at[0] : 4 * at[1]]
        self.after, self.tail_ids = 4 * at[3], raw[4 * at[2] : 4 * at[3]]


def _some_seams(data: bytes, side: int, n: int) -> list[int]:
    """The first or last n seams, or all there are in growing parts of the data."""
    part = 128
    while True:
        if side == 0:
            found = [m.start() for m in SEAM.finditer(data, 0, part)][:n]
        else:
            found = [m.start() for m in SEAM.finditer(data, max(0, len(data) - part))][-n:]
        if len(found) == n or part >= len(data):
            return found
        part *= 4


class ChunkEncoder:
    """ids(texts): the ids of each text through its chunks, and how many chunks it has and how many of them were known."""

    def __init__(self, path: str):
        self.enc = PieceEncoder(path)
        self.pieces = self.enc.byte_table()
        self.sizes = np.array([len(x) for x in self.pieces], np.int64)
        self.young: dict[bytes, Chunk] = {}
        self.old: dict[bytes, Chunk] = {}
        self.held = self.grown = 0

    def chunks(self, parts: set[bytes]) -> tuple[dict[bytes, Chunk], set[bytes]]:
        """The chunk of each of the parts, and those that were new."""
        got = {p: c for p in parts if (c := self.young.get(p) or self.old.get(p))}
        new = [p for p in parts if p not in got]
        for p, raw in zip(new, self.enc.ids([p.decode() for p in new]), strict=True):
            got[p] = Chunk(p, raw, self.sizes)
        size = sum(len(p) + 2 * len(c.raw) + 600 for p, c in got.items())
        if self.held + size > KEPT_BYTES // 2:
            self.old, self.young, self.held = self.young, {}, 0
        if size <= KEPT_BYTES // 2:
            self.young.update(got)
            self.held += size
        return got, set(new)

    def ids(self, texts: list[str]) -> tuple[list[bytes], list[tuple[int, int]]]:
        split = []
        for t in texts:
            data, a = t.encode(), 0
            split.append([])
            for b in cuts(data):
                split[-1].append(data[a:b])
                a = b
        known, new = self.chunks({p for parts in split for p in parts if p})
        told = []
        for parts in split:
            fresh = 0
            for p in parts:
                if p in new:
                    new.discard(p)  # it is encoded for the first one that has it
                    fresh += 1
            told.append((len(parts), len(parts) - fresh))
        lines: list[list] = [[known[p] for p in parts if p] for parts in split]
        out: list[bytes | None] = [b"".join(c.raw for c in x) if len(x) < 2 else None for x in lines]
        while todo := [k for k, x in enumerate(out) if x is None]:
            wanted = [w for k in todo for w in windows(lines[k])]
            found = iter(self.enc.ids([w.decode() for w in wanted]))
            for k in todo:
                out[k] = self.joined(lines[k], found)
        return out, told

    def joined(self, line: list, found: Iterator[bytes]) -> bytes | None:
        """The ids of chunks (and given-up data) in a line from the ids of their windows(); None where a join does not agree: its
        chunks are given up in line then."""
        out, left, wrong = [], None, set()
        strong = [c for c in line if isinstance(c, Chunk) and c.joins]
        for right in [*strong, None]:
            ids = next(found)
            head = left.tail_ids if left else b""
            tail = right.head_ids if right else b""
            if len(head) + len(tail) > len(ids) or not ids.startswith(head) or not ids.endswith(tail):
                wrong |= {id(c) for c in (left, right) if c}
            out.append(ids[len(head) : len(ids) - len(tail)])
            if right:
                out.append(right.raw[right.before : right.after])
            left = right
        if not wrong:
            return b"".join(out)
        self.grown += 1
        line[:] = [c.data if isinstance(c, Chunk) and id(c) in wrong else c for c in line]
        return None

    def decode(self, ids: bytes) -> bytes:
        """The text of ids in UTF-8; bytes that are no UTF-8 become U+FFFD."""
        data = b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        try:
            data.decode()
        except UnicodeDecodeError:
            return data.decode(errors="replace").encode()
        return data


def windows(line: list) -> Iterator[bytes]:
    """What is encoded anew of a line of chunks: before the first chunk that joins, between each two, and after the last."""
    part: list[bytes] = []
    for c in line:
        if isinstance(c, Chunk) and c.joins:
            part.append(c.head)
            yield b"".join(part)
            part = [c.tail]
        else:
            part.append(c.data if isinstance(c, Chunk) else c)
    yield b"".join(part)


def chunker(path: str) -> ChunkEncoder:
    return kept(("chunks", path), lambda: ChunkEncoder(path))


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def encode_decode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: id_col, n_tokens, ids (little-endian unsigned 32-bit) and decoded
    (UTF-8), exactly as the tokenizers library gives them for a byte-level .json file.

    Null text is empty: no ids, empty decoding. Null ids stay null, repeated rows are kept each, an
    empty table gives no rows, other columns are not read. A very long text is cut into chunks of at
    most LONGEST bytes. A worker keeps at most KEPT_BYTES of chunks. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = chunker(tokenizer)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in by_bytes(texts):
                ids, _ = enc.ids([t or "" for t in texts[a:b]])
                yield table(OUT, id=batch.column("id").slice(a, b - a), n_tokens=[len(x) // 4 for x in ids], ids=ids, decoded=[enc.decode(x) for x in ids])
        trimmed()

    return _rows(df, id_col, text_col).mapInArrow(run, "id long, n_tokens long, ids binary, decoded binary").withColumnRenamed("id", id_col)


def encode_decode_digests(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """encode_decode() with digests taken where the ids are made: id_col, n_tokens, ids_sha256,
    decoded_sha256, n_chunks and how many of these the worker had encoded before (n_reused)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, sha = chunker(tokenizer), hashlib.sha256
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in by_bytes(texts):
                ids, told = enc.ids([t or "" for t in texts[a:b]])
                yield table(
                    DIGEST, id=batch.column("id").slice(a, b - a), n_tokens=[len(x) // 4 for x in ids], ids_sha256=[sha(x).hexdigest() for x in ids],
                    decoded_sha256=[sha(enc.decode(x)).hexdigest() for x in ids], n_chunks=[n for n, _ in told], n_reused=[k for _, k in told],
                )
        trimmed()

    return _rows(df, id_col, text_col).mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_chunks long, n_reused long").withColumnRenamed("id", id_col)
