"""SimHash near-duplicates: exact comparison of tiles of fingerprints.

Fingerprints are dealt into tiles by the population counts of their four 16-bit quarters. The
differing bits of two fingerprints are at least the sum of the differences of these counts, so a
pair of tiles whose counts differ by more than the radius is never formed. Every other pair is
formed once: a fingerprint goes to its own tile as a member and, as a visitor, to those of the
neighbouring tiles that follow its own. Large tiles are cut into blocks, and each pair of blocks is a task's.
Blocks of visitors and members are compared by exclusive-or and bit counts, all pairs, without cap.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.llm.components import components
from siltstone.llm.shared import by_bytes, free_name, mixed, settled, table, trimmed

RADIUS = 3
SHINGLE = 3
SEED = 42
QUARTER = 16
BLOCK = 1024
#: Fingerprints of a tile that a task compares with so many others; a larger tile is cut into blocks.
BLOCK_ROWS = 1 << 17
AT_HOME, HELD, VISITING = 0, 1, 2
#: Parts of a class where its fingerprints are joined with its name.
SALTS = 16
#: Bytes of text hashed together.
HASHED = 2 << 20

PRINTS = pa.schema([("id", pa.int64()), ("fp", pa.int64())])
DEALT = pa.schema([("cell", pa.int64()), ("role", pa.int8()), ("fp", pa.int64())])
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of `shingle` words of the text with A-Z in lower case, joined by spaces."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(line, seed)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)), np.uint64, len(starts))


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """For each array, the bits set in over half of its members; zero for none."""
    sizes = np.array([len(h) for h in hashes])
    out = np.zeros(len(hashes), np.uint64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    every, n = np.concatenate([hashes[i] for i in some]), sizes[some]
    parts = -(-n // 255)  # runs in which a count fits into a byte
    run = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    runs = np.repeat(np.cumsum(n) - n, parts) + 255 * run
    texts = np.cumsum(parts) - parts
    for k in range(8):  # bit k of each byte of the hashes
        counts = np.add.reduceat((every >> np.uint64(k)) & LANES, runs).astype("<u8").view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(counts, texts, axis=0, dtype=np.int64)
        for byte in range(8):
            out[some] |= (2 * counts[:, byte] > n).astype(np.uint64) << np.uint64(8 * byte + k)
    return out


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(id, fp): the 64-bit SimHash of every whole text; texts of fewer words are one shingle, null
    and wordless ones have fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in by_bytes(texts, HASHED):
                prints = majority([shingle_hashes(t, shingle, seed) for t in texts[a:b]])
                yield table(PRINTS, id=batch.column("id").slice(a, b - a), fp=prints.view(np.int64))
        trimmed()

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, fp long")


def quarters(fp: np.ndarray) -> np.ndarray:
    return np.stack([np.bitwise_count((fp >> np.uint64(QUARTER * k)) & np.uint64(0xFFFF)).astype(np.int32) for k in range(4)], axis=1)


def steps(radius: int) -> np.ndarray:
    """Differences of quarter counts within the radius that lead to a tile that follows."""
    near = [d for d in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, d)) <= radius]
    return np.array([d for d in near if d > (0, 0, 0, 0)], np.int32).reshape(-1, 4)


WIDTH = np.array([QUARTER + 1], np.int32) ** np.arange(3, -1, -1, dtype=np.int32)
TILES = (QUARTER + 1) ** 4


def tile_of(fp: np.ndarray) -> np.ndarray:
    return quarters(fp) @ WIDTH


def tile_sizes(prints: DataFrame) -> np.ndarray:
    """How many fingerprints are at home in each tile; at most TILES rows come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(TILES, np.int64)
        for batch in batches:
            n += np.bincount(tile_of(batch.column("fp").to_numpy().view(np.uint64)), minlength=TILES)
        some = np.flatnonzero(n)
        yield table(pa.schema([("tile", pa.int32()), ("n", pa.int64())]), tile=some.astype(np.int32), n=n[some])

    got = prints.select("fp").mapInArrow(run, "tile int, n long").groupBy("tile").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(TILES, np.int64)
    out[got.column("tile").to_numpy()] = got.column("n").to_numpy()
    return out


@dataclass
class Cells:
    """How tiles are cut: blocks of the fingerprints at home and of those that visit, and the number of each tile's first cell.

    A tile with m blocks at home and g blocks of visitors has m rows of m + g - 1 cells. The cell (i, j) for j < m is for
    blocks i and j at home, or, for i = j, for block i alone and the first block of visitors; the cells that follow in row i are for block i and
    the other blocks of visitors. So every pair within reach meets in one cell, and a cell has two blocks, or three."""

    home: np.ndarray
    visiting: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(sizes: np.ndarray, radius: int, block_rows: int) -> Cells:
        lived = np.flatnonzero(sizes)
        where = np.stack(np.unravel_index(lived, (QUARTER + 1,) * 4), axis=1)
        coming = np.zeros(TILES, np.int64)
        for step in steps(radius):
            to = where + step
            inside = ((to >= 0) & (to <= QUARTER)).all(axis=1)
            np.add.at(coming, to[inside] @ WIDTH, sizes[lived[inside]])
        home = -(-sizes // block_rows)  # none where nobody is at home
        visiting = np.maximum(-(-coming // block_rows), 1)
        cells = home * (home + visiting - 1)
        return Cells(home, visiting, np.cumsum(cells) - cells)


def deal(prints: DataFrame, radius: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Distinct fingerprints -> (cell, role, fp): each in the cells of its own tile, then in those of each tile within reach that follows.
    Roles: AT_HOME is compared with its like too, HELD only with visitors, VISITING with all others."""
    sent = prints.sparkSession.sparkContext.broadcast(Cells.of(tile_sizes(prints), radius, block_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead, cells = steps(radius), sent.value
        for batch in batches:
            whole = batch.column("fp").to_numpy().view(np.uint64)
            for a in range(0, len(whole), 4096):
                fp = whole[a : a + 4096]
                home, block = quarters(fp), (mixed(fp) >> np.uint64(20)).astype(np.int64)
                tile = (home @ WIDTH).astype(np.int64)
                m, n = cells.home[tile], cells.home[tile] + cells.visiting[tile] - 1
                row = np.repeat(np.arange(len(fp)), n)
                j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                mine, n, m = (block % m)[row], n[row], m[row]
                right = (j < m) & (j < mine)  # the pair with an earlier block is that block's row
                cell = cells.first[tile][row] + np.where(right, j * n + mine, mine * n + j)
                role = np.where(right, VISITING, np.where(j == mine, AT_HOME, HELD))

                to = home[:, None, :] + ahead[None, :, :]
                guest, step = np.nonzero(((to >= 0) & (to <= QUARTER)).all(axis=2))
                tile = (to[guest, step] @ WIDTH).astype(np.int64)
                m = cells.home[tile]
                which = np.repeat(np.arange(len(guest)), m)
                i = np.arange(len(which)) - np.repeat(np.cumsum(m) - m, m)
                tile, m = tile[which], m[which]
                part = block[guest][which] % cells.visiting[tile]
                there = cells.first[tile] + i * (m + cells.visiting[tile] - 1) + np.where(part == 0, i, m + part - 1)
                yield table(
                    DEALT, cell=np.concatenate([cell, there]), role=np.concatenate([role, np.full(len(there), VISITING)]).astype(np.int8),
                    fp=np.concatenate([fp[row], fp[guest][which]]).view(np.int64),
                )

    return prints.select("fp").mapInArrow(run, "cell long, role tinyint, fp long")


class Tile:
    """Members of one tile, with the classes that links have put them in so far."""

    def __init__(self, radius: int):
        self.radius, self.members, self.parent, self.links = radius, np.empty(0, np.uint64), np.empty(0, np.int64), []

    def classes(self, members: np.ndarray) -> np.ndarray:
        """The classes of members, ascending, each once."""
        found = np.unique(self.parent[members])
        while ((up := self.parent[found]) != found).any():
            found = np.unique(up)
        return found

    def _linked(self, fps: np.ndarray, upto: int, own: int | None) -> None:
        """Compares fps with the first `upto` members; own: the place of fps among the members."""
        for a in range(0, len(fps), BLOCK):
            some, rows, cols = fps[a : a + BLOCK], [], []
            for b in range(0, upto if own is None else own + a + len(some), BLOCK):
                r, c = np.nonzero(np.bitwise_count(some[:, None] ^ self.members[None, b : b + BLOCK]) <= self.radius)
                rows.append(r)
                cols.append(c + b)
            if not rows:
                continue
            row, col = np.concatenate(rows), np.concatenate(cols)
            if own is not None:
                row, col = row[col < own + a + row], col[col < own + a + row]
            order = np.argsort(row, kind="stable")
            row, col = row[order], col[order]
            for r, cs in zip(*self._split(row, col), strict=True):
                found = self.classes(cs if own is None else np.append(cs, own + a + r))  # a member's own class joins
                root = found[0]
                if own is None:
                    self.links.append((some[r], self.members[root]))
                for other in found[1:]:
                    self.links.append((self.members[other], self.members[root]))
                self.parent[found] = root
                self.parent[cs] = root

    @staticmethod
    def _split(row: np.ndarray, col: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
        if not len(row):
            return [], []
        at = np.flatnonzero(np.diff(row)) + 1
        return row[np.concatenate([[0], at])].tolist(), np.split(col, at)

    def hold(self, fps: np.ndarray) -> None:
        self.parent = np.concatenate([self.parent, np.arange(len(self.members), len(self.members) + len(fps))])
        self.members = np.concatenate([self.members, fps])

    def home(self, fps: np.ndarray) -> None:
        own = len(self.members)
        self.hold(fps)
        self._linked(fps, len(self.members), own)

    def visit(self, fps: np.ndarray) -> None:
        self._linked(fps, len(self.members), None)

    def drain(self) -> pa.RecordBatch | None:
        if not self.links:
            return None
        pairs = np.array(self.links, np.uint64).view(np.int64)
        self.links = []
        return table(EDGES, a=np.ascontiguousarray(pairs[:, 0]), b=np.ascontiguousarray(pairs[:, 1]))


def links(prints: DataFrame, radius: int = RADIUS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): pairs that connect what links of radius or fewer differing bits connect, and nothing else.
    A cell gives a fingerprint paired with one member of its class, and classes that it joins, not
    all pairs within a class; so pairs grow with the fingerprints, not with the square of a class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, now = None, None
        for batch in batches:
            cells, roles, fp = (batch.column(c).to_numpy() for c in ("cell", "role", "fp"))
            edges = np.flatnonzero(np.diff(cells * 4 + roles)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(cells)], strict=True):
                if a == b:
                    continue
                if cells[a] != now:
                    if tile and (out := tile.drain()):
                        yield out
                    tile, now = Tile(radius), cells[a]
                {AT_HOME: tile.home, HELD: tile.hold, VISITING: tile.visit}[int(roles[a])](fp[a:b].view(np.uint64))
        if tile and (out := tile.drain()):
            yield out
        trimmed()

    dealt = deal(prints, radius, block_rows)
    return dealt.repartition("cell").sortWithinPartitions("cell", "role").mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: id_col, fingerprint (16 lower-case hex digits), component_id: the
    smallest id that links lead to, its own included.

    Null and wordless texts have fingerprint zero and link like any other. A null id keeps its row
    and never names a component (null where it would be alone); rows of one id count as linked only
    through their texts; an empty table gives no rows; other columns are not read. Copies share a
    fingerprint and are compared once. The memory of a task is three blocks of BLOCK_ROWS fingerprints.
    """
    prints = settled(fingerprints(df, id_col, text_col, shingle, seed), "prints")
    distinct = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(distinct, radius))
    root = F.coalesce("root", "fp")
    grouped = settled(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", root.alias("root")), "roots")
    # classes of more than one fingerprint only
    several = roots.select("root").distinct()
    named = grouped.join(several, "root", "left_semi").groupBy("root").agg(F.min("least").alias("named"))
    # a class may be large: its fingerprints meet its name in SALTS tasks
    salted = named.select(F.col("root").alias("of"), "named", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part"))
    parted = grouped.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)))
    labels = parted.join(salted, (F.col("root") == F.col("of")) & (F.col("salt") == F.col("part")), "left").select(F.col("fp").alias("own"), F.coalesce("named", "least").alias("component_id"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(labels, F.col("fp") == F.col("own")).select(F.col("id").alias(id_col), hexed, "component_id")


def representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """df with one row of each class of near_duplicates(): that of the smallest id; of several rows
    of that id, the one with the least text. Rows with a null id all stay."""
    one, nth = free_name(df, "siltstone_kept"), free_name(df, "siltstone_nth")
    classes = near_duplicates(df, id_col=id_col, text_col=text_col, **options)
    chosen = classes.filter(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias(one)).distinct()
    alone = df.filter(F.col(id_col).isNotNull()).join(chosen, F.col(id_col) == F.col(one), "left_semi")
    alone = alone.withColumn(nth, F.row_number().over(W.partitionBy(id_col).orderBy(text_col))).filter(F.col(nth) == 1).select(*df.columns)
    return alone.unionByName(df.filter(F.col(id_col).isNull()))
