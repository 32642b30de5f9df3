"""Packing token sequences by minimum bin slack.

Documents longer than the window give whole windows and a remainder. How many pieces there are of
each length is a table of at most `capacity` rows whatever the input; from it the driver plans
windows: the longest remaining piece is fixed, a subset-sum table held as a bitset (bit s: sum s can
be reached with what remains of each length) finds the sum closest to what is left of the window, and
the lengths used are read back from the table. A window's multiset is used as often as the counts
allow. Executors then place pieces by arithmetic on (length, rank within the length).

Windows that cannot be filled exactly are laid end to end and cut anew at the capacity; what remains
of them at the end is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.llm.shared import by_bytes, settled, table, trimmed
from siltstone.llm.tokenizing import CACHE_ENTRIES, encoder

#: A length's pieces are ranked in parts of about this many rows at most, and in RANK_PARTS parts at least.
PART_ROWS, RANK_PARTS = 500_000, 64

NATURAL = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()), ("doc_tokens", pa.int64()), ("doc_crc", pa.int64())])
PLACED = pa.schema([*NATURAL, ("sequence_id", pa.int64()), ("offset", pa.int64())])
NATURAL_SQL = "id long, start long, length long, crc long, doc_tokens long, doc_crc long"


@dataclass
class Group:
    """`times` windows, each with these (length, count)."""

    parts: list[tuple[int, int]]
    times: int

    @property
    def total(self) -> int:
        return sum(size * n for size, n in self.parts)


def closest(lengths: list[int], counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, count) with the largest sum that is at most room; lengths descend."""
    reach, steps, goal, mask = 1, [], 1 << room, (1 << (room + 1)) - 1
    for size in lengths[bisect_left(lengths, -room, key=lambda x: -x) :]:
        n, take = min(counts[size], room // size), 1
        while n > 0:
            take = min(take, n)
            steps.append((size, take, reach))
            reach |= (reach << (size * take)) & mask
            n -= take
            take *= 2
        if reach & goal:
            break
    left, used = reach.bit_length() - 1, {}
    for size, take, before in reversed(steps):
        if not before >> left & 1:
            used[size] = used.get(size, 0) + take
            left -= size * take
    return sorted(used.items(), reverse=True)


def plan(counts: dict[int, int], capacity: int) -> list[Group]:
    """Windows for counts[length] pieces of each length up to capacity, by minimum bin slack."""
    counts = {k: v for k, v in counts.items() if v}
    lengths = sorted(counts, reverse=True)
    out = []
    while lengths:
        top = lengths[0]
        counts[top] -= 1
        found = dict(closest(lengths, counts, capacity - top)) if top < capacity else {}
        counts[top] += 1
        found[top] = found.get(top, 0) + 1
        times = min(counts[k] // n for k, n in found.items())
        out.append(Group(sorted(found.items(), reverse=True), times))
        for k, n in found.items():
            counts[k] -= n * times
            if not counts[k]:
                lengths.remove(k)
    return out


@dataclass
class Layout:
    """plan() as arrays: for each (length, first rank) of a range of ranks, where its pieces go."""

    keys: np.ndarray  # length << 40 | first rank
    cells: np.ndarray  # first rank, pieces a window, offset in the window, first window or stream position, window's total, 1 if loose
    edges: np.ndarray  # ends of the sequences of the stream of loose windows
    exact: int


def layout(groups: list[Group], capacity: int) -> Layout:
    rank: dict[int, int] = {}
    rows, exact, stream = [], 0, 0
    for g in groups:
        loose, at = g.total < capacity, 0
        for size, n in g.parts:
            lo = rank.get(size, 0)
            rank[size] = lo + n * g.times
            rows.append((size << 40 | lo, lo, n, at, stream if loose else exact, g.total, int(loose)))
            at += size * n
        if loose:
            stream += g.total * g.times
        else:
            exact += g.times
    rows.sort()
    cells = np.array(rows, np.int64).reshape(-1, 7)
    rest = stream % capacity
    tail = [1 << k for k in range(capacity.bit_length(), -1, -1) if rest >> k & 1]
    edges = np.concatenate([np.arange(1, stream // capacity + 1, dtype=np.int64) * capacity, stream - rest + np.cumsum(np.array(tail, np.int64))]) if stream else np.array([], np.int64)
    return Layout(cells[:, 0].copy(), cells[:, 1:].copy(), edges.astype(np.int64), exact)


def natural_pieces(df: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str, text_col: str, entries: int = CACHE_ENTRIES) -> DataFrame:
    """Each document's whole windows and its remainder, with the CRC-32 of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer, entries), end_id.to_bytes(4, "little")
        for batch in batches:
            texts, names = batch.column("text").to_pylist(), batch.column("id").to_pylist()
            for a, b in by_bytes(texts):
                rows = []
                for name, ids in zip(names[a:b], enc.ids([t or "" for t in texts[a:b]]), strict=True):
                    ids += end
                    n, whole = len(ids) // 4, zlib.crc32(ids)
                    for start in range(0, n, capacity):
                        part = ids if n <= capacity else ids[4 * start : 4 * (start + capacity)]
                        rows.append((name, start, len(part) // 4, whole if n <= capacity else zlib.crc32(part), n, whole))
                yield table(NATURAL, **dict(zip(NATURAL.names, map(list, zip(*rows, strict=True)), strict=True)))
        trimmed()

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, NATURAL_SQL)


def place(ranked: DataFrame, lay: Layout) -> DataFrame:
    """Pieces with their rank -> pieces with sequence_id and offset; where a piece had to be cut,
    its parts have no crc yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {k: np.asarray(batch.column(k).to_numpy(zero_copy_only=False)) for k in ("start", "length", "crc", "doc_tokens", "doc_crc", "rank")}
            size = col["length"]
            lo, n, at, base, total, loose = lay.cells[np.searchsorted(lay.keys, size << 40 | col["rank"], "right") - 1].T
            copy, k = np.divmod(col["rank"] - lo, n)
            offset = at + k * size
            pos = base + copy * total + offset  # in the stream, where loose
            first = np.searchsorted(lay.edges, pos, "right")
            last = np.searchsorted(lay.edges, pos + size, "left")
            parts = np.where(loose == 1, last - first + 1, 1)
            row = np.repeat(np.arange(len(size)), parts)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            is_loose, seq = loose[row] == 1, first[row] + nth
            edges = np.concatenate([[0], lay.edges])
            a = np.where(is_loose, np.maximum(pos[row], edges[np.minimum(seq, len(edges) - 1)]), 0)
            b = np.where(is_loose, np.minimum(pos[row] + size[row], edges[np.minimum(seq + 1, len(edges) - 1)]), size[row])
            cut = parts[row] > 1
            yield table(
                PLACED, id=batch.column("id").take(pa.array(row)), start=col["start"][row] + np.where(is_loose, a - pos[row], 0), length=b - a,
                crc=pa.array(col["crc"][row], pa.int64(), mask=cut), doc_tokens=col["doc_tokens"][row], doc_crc=col["doc_crc"][row],
                sequence_id=np.where(is_loose, lay.exact + seq, (base + copy)[row]), offset=np.where(is_loose, a - edges[np.minimum(seq, len(edges) - 1)], offset[row]),
            )

    return ranked.mapInArrow(run, NATURAL_SQL + ", sequence_id long, offset long")


def pack(df: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text", entries: int = CACHE_ENTRIES) -> DataFrame:
    """Packs every row of df into sequences of at most `capacity` ids (at most 65,536): one row a piece with
    id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are a document of end_id alone. Null ids stay null; repeated rows are packed
    each; an empty table gives no rows; other columns are not read. A very long text gives many whole
    windows; `entries` bounds an encoder's caches, not what it finds. Ties between pieces of a length go by id, then start. Shuffles only piece rows (no text);
    documents that get cut are encoded again, found by a join on the id.
    """
    if not 0 < capacity <= 65_536:
        raise ValueError("capacity must be from 1 to 65536")
    pieces = settled(natural_pieces(df, tokenizer, end_id, capacity, id_col, text_col, entries), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    parts = max(RANK_PARTS, -(-sum(counts.values()) // PART_ROWS))
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("id", "start", "doc_crc"), F.lit(parts)))
    lengths = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    lay = layout(plan(counts, capacity), capacity)
    before = lengths.select("length", "part", (F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    within = F.row_number().over(W.partitionBy("length", "part").orderBy("id", "start", "crc"))
    ranked = pieces.withColumn("nth", within).join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth") - 1)
    placed = settled(place(ranked.select(*NATURAL.names, "rank"), lay), "placed")

    cut = placed.filter(F.col("crc").isNull()).drop("crc")
    texts = df.select(F.col(id_col).cast("long").alias("id0"), F.col(text_col).alias("text"))
    spans = F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("spans")
    wanted = settled(cut.groupBy("id", "doc_tokens", "doc_crc").agg(spans), "cut")  # of known size: texts are shuffled only where it is large

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer, entries), end_id.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                ids = enc.ids([r["text"] or ""])[0] + end
                if (len(ids) // 4, zlib.crc32(ids)) == (r["doc_tokens"], r["doc_crc"]):  # else another row of the same id
                    for s in r["spans"]:
                        crc = zlib.crc32(ids[4 * s["start"] : 4 * (s["start"] + s["length"])])
                        rows.append((r["id"], s["start"], s["length"], crc, r["doc_tokens"], r["doc_crc"], s["sequence_id"], s["offset"]))
            if rows:
                yield table(PLACED, **dict(zip(PLACED.names, map(list, zip(*rows, strict=True)), strict=True)))

    joined = texts.join(wanted, F.col("id0").eqNullSafe(F.col("id"))).drop("id0")
    mended = joined.mapInArrow(again, NATURAL_SQL + ", sequence_id long, offset long").dropDuplicates(["sequence_id", "offset"])
    every = placed.filter(F.col("crc").isNotNull()).unionByName(mended)
    return every.select(F.col("id").alias(id_col), "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
