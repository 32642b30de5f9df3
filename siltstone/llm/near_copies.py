"""Near copies by the general rule: texts whose sets of five-word shingles have a Jaccard similarity
of 0.8 or more, by SimHash with an exact check, and whole.

Each set has a SimHash fingerprint; what simhash.links() connects is compared by whole sets. Alike sets may have fingerprints
that differ in more bits than any affordable radius, so the pairs that SimHash leaves out are found by a join and checked in the same way.

Two sets that are so alike share one of the first n - ceil(0.8 n) + 1 members of each in any common
order, so every pair meets at a member of both beginnings. Shingles that many texts have come last in
the order; a sample of counts settles it and decides only what the search costs, not what it finds.
Pairs that meet are compared by their whole sets unless sketches of these differ too much already. First each text is compared with a few of those it
meets at a shingle; then all pairs that are not in one class by then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.llm import simhash
from siltstone.llm.components import components
from siltstone.llm.shared import ODD, by_bytes, dropped, free_name, line_words, mixed, settled, table, tidy
from siltstone.llm.substring import MOST_BLOOM, keys_held

SHINGLE = 5
#: The least similarity, as a fraction.
NUMERATOR, DENOMINATOR = 4, 5
HASHED = 1 << 18
#: A shingle is counted where this many texts of a step have it; so many of the most frequent come last.
OFTEN, MOST_COUNTED, STEP = 8, 1 << 18, 1 << 20
#: Members of a shingle's texts that all the others are compared with at first.
PIVOTS = 1
#: Bits of a sketch, at least and at most; two of them differ in no more bits than their sets in members.
SKETCH, MOST_SKETCH = 1 << 10, 1 << 15
#: Members of the largest sets whose sketches still tell sets apart when folded to SKETCH bits.
SHORT = 1 << 11

COUNTS = pa.schema([("shingle", pa.int64()), ("n", pa.int64())])
DIGESTS = pa.schema([("id", pa.int64()), ("digest", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()), ("fp", pa.int64())])
BEGINNINGS = pa.schema([("shingle", pa.int64()), ("digest", pa.int64()), ("n", pa.int32()), ("place", pa.int32())])
OPEN = pa.schema([*BEGINNINGS, ("root", pa.int64())])
FOLDED = pa.schema([("digest", pa.int64()), ("sketch", pa.binary())])
PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
SETS = pa.schema([("digest", pa.int64()), ("members", pa.binary())])


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """For each text the ascending 64-bit hashes of its runs of five words, A-Z in lower case, words
    parted by ASCII white space; a shorter text is one shingle, a null or wordless one has none."""
    _, _, _, words, at = line_words([t.encode().lower() if t else b"" for t in texts])
    n = np.diff(at)
    runs = np.where(n > 0, np.maximum(n - SHINGLE + 1, 1), 0)
    to = np.cumsum(runs)
    begin = np.arange(runs.sum()) - np.repeat(to - runs, runs) + np.repeat(at[:-1], runs)
    size = np.minimum(np.repeat(n, runs), SHINGLE)
    hashes = mixed(size.astype(np.uint64))
    padded = np.append(words, np.zeros(SHINGLE, np.uint64))
    for k in range(SHINGLE):
        hashes = mixed(hashes * ODD ^ np.where(k < size, padded[begin + k], np.uint64(0)))
    return [np.unique(x) for x in np.split(hashes, to[:-1])]


def digest(members: np.ndarray) -> int:
    """A 64-bit hash of a set, as a signed number."""
    return int(mixed(np.array([mixed(members).sum(dtype=np.uint64) + np.uint64(len(members))], np.uint64)).view(np.int64)[0])


def sketch(members: np.ndarray) -> bytes:
    """Whether the number of members that fall on each of some places is odd. Places are a power of two that grows with the
    set, so that sets that are hardly alike differ in more places than is allowed; those of a larger set can be folded."""
    bits = min(max(SKETCH, 1 << (len(members) - 1).bit_length()), MOST_SKETCH)
    return np.packbits(np.bincount((mixed(members) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).tobytes()


def folded(sketch: bytes) -> bytes:
    """A sketch in SKETCH bits."""
    x = np.frombuffer(sketch, np.uint64)
    while len(x) > SKETCH // 64:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x.tobytes()


def differing(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """Places in which the sketches x[i] and y[i] differ, the larger folded to the size of the smaller."""
    out, sizes = np.zeros(len(x), np.int64), np.array([[len(p), len(q)] for p, q in zip(x, y, strict=True)]).reshape(-1, 2)
    for size in np.unique(sizes, axis=0):
        rows = np.flatnonzero((sizes == size).all(axis=1))
        p, q = (np.frombuffer(b"".join(z[i] for i in rows), np.uint64).reshape(len(rows), -1) for z in (x, y))
        least = int(size.min()) // 8
        while p.shape[1] > least:
            p = p[:, : p.shape[1] // 2] ^ p[:, p.shape[1] // 2 :]
        while q.shape[1] > least:
            q = q[:, : q.shape[1] // 2] ^ q[:, q.shape[1] // 2 :]
        out[rows] = np.bitwise_count(p ^ q).sum(axis=1, dtype=np.int64)
    return out


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    texts = batch.column("text").to_pylist()
    for a, b in by_bytes(texts, HASHED):
        yield a, b, shingle_sets(texts[a:b])


def digests(texts: DataFrame) -> DataFrame:
    """(id, digest, n, sketch, fp) of every row; fp is the SimHash fingerprint of the set, zero for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, sets in _sets(batch):
                yield table(DIGESTS, id=batch.column("id").slice(a, b - a), digest=[digest(s) for s in sets], n=list(map(len, sets)), sketch=[sketch(s) for s in sets], fp=simhash.majority(sets).view(np.int64))

    return texts.mapInArrow(tidy(run), "id long, digest long, n long, sketch binary, fp long")


def fingerprint_pairs(sketches: DataFrame, radius: int = simhash.RADIUS) -> DataFrame:
    """Distinct pairs (a, b) of digests that SimHash connects: sets of one fingerprint with the least of them, and the
    least ones of fingerprints that simhash.links() pairs. They grow with the sets, not with the square of a class."""
    some = sketches.filter("n > 0").groupBy("fp").agg(F.min("digest").alias("least"), F.count("*").alias("of"))
    some = settled(some, "fingerprints")
    several = some.filter("of > 1").select(F.col("fp").alias("own"), "least")
    equal = sketches.filter("n > 0").join(several, F.col("fp") == F.col("own")).select(F.col("digest").alias("x"), F.col("least").alias("y"))
    ends = [some.select(F.col("fp").alias(k), F.col("least").alias(v)) for k, v in (("a", "x"), ("b", "y"))]
    close = simhash.links(some.select("fp"), radius).distinct().join(ends[0], "a").join(ends[1], "b").select("x", "y")
    out = settled(close.unionByName(equal).filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "simhash-pairs")
    dropped(some)
    return out


def frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ascending hashes of shingles that many texts have, and about how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []

        def often() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            return table(COUNTS, shingle=found[n >= OFTEN].view(np.int64), n=n[n >= OFTEN])

        size = 0
        for batch in batches:
            for _, _, sets in _sets(batch):
                waiting.append(np.concatenate(sets))
                size += len(waiting[-1])
                if size > STEP:
                    yield often()
                    size = 0
        if waiting:
            yield often()

    counted = texts.select("text").mapInArrow(tidy(run), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    got = counted.orderBy(F.desc("n"), "shingle").limit(MOST_COUNTED).toArrow()
    shingle, n = got.column("shingle").to_numpy().view(np.uint64), got.column("n").to_numpy()
    at = np.argsort(shingle)
    return shingle[at], n[at]


def needed(n):
    """The members that a set of n shares at least with one that is alike."""
    return -(-NUMERATOR * n // DENOMINATOR)


def beginnings(texts: DataFrame, counts: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(shingle, digest, n, place): the first members of every set of n, rare ones first; equal sets of a task once."""
    sent = texts.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, times = sent.value
        met: set[int] = set()
        for batch in batches:
            for _, _, sets in _sets(batch):
                new = []
                for s in sets:
                    d = digest(s)
                    if len(s) and d not in met:
                        met.add(d)
                        new.append((d, s))
                if not new:
                    continue
                size = np.array([len(s) for _, s in new])
                every, doc = np.concatenate([s for _, s in new]), np.repeat(np.arange(len(new)), size)
                count = np.zeros(len(every), np.int64)
                if len(often):
                    at = np.minimum(np.searchsorted(often, every), len(often) - 1)
                    count = np.where(often[at] == every, times[at], 0)
                order = np.lexsort((mixed(every), count, doc))
                place = np.arange(len(every)) - np.repeat(np.cumsum(size) - size, size)
                start = place < np.repeat(size - needed(size) + 1, size)
                which = doc[start]
                yield table(BEGINNINGS, shingle=every[order][start].view(np.int64), digest=np.array([d for d, _ in new], np.int64)[which], n=size[which], place=place[start])

    return texts.select("text").mapInArrow(tidy(run), "shingle long, digest long, n int, place int")


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns in steps that do not part the rows of one shingle, which follow each other."""
    held = None
    for batch in batches:
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now, strict=True)]
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))
        held = [x[cut:] for x in now]
        if cut:
            yield tuple(x[:cut] for x in now)
    if held is not None:
        yield tuple(held)


def shared(starts: DataFrame) -> DataFrame:
    """The rows of beginnings() whose shingle two sets or more begin with, each once."""
    names = tuple(BEGINNINGS.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _groups(batches, names):
            s, d = columns[0], columns[1]
            once = np.concatenate([[True], (s[1:] != s[:-1]) | (d[1:] != d[:-1])])
            columns = [x[once] for x in columns]
            same = np.concatenate([[False], columns[0][1:] == columns[0][:-1], [False]])
            several = same[1:] | same[:-1]
            if several.any():
                yield table(BEGINNINGS, **{k: x[several] for k, x in zip(names, columns, strict=True)})

    return starts.repartition("shingle").sortWithinPartitions("shingle", "digest").mapInArrow(tidy(run), "shingle long, digest long, n int, place int")


def _may(n, place, i, j) -> np.ndarray:
    """Whether sets whose first common member is at these places can be alike."""
    least = -(-NUMERATOR * (n[i].astype(np.int64) + n[j]) // (NUMERATOR + DENOMINATOR))
    return (np.minimum(n[i] - place[i], n[j] - place[j]) >= least) & (np.minimum(n[i], n[j]) >= needed(np.maximum(n[i], n[j])))


def _pairs(digest: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    return table(PAIRS, a=np.minimum(digest[i], digest[j]), b=np.maximum(digest[i], digest[j]))


def first_pairs(met: DataFrame) -> DataFrame:
    """Distinct pairs of each member of a shingle's texts and a few pivots: those with the fewest rarer members before it. In a
    group of near copies these are the texts with the least changes of their own, to which most others are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, d, n, place in _groups(batches, tuple(BEGINNINGS.names)):
            group = np.cumsum(np.concatenate([[0], s[1:] != s[:-1]]))
            order = np.lexsort((mixed(d.view(np.uint64)), place, group))
            begin = np.searchsorted(group, np.arange(group[-1] + 2))  # order keeps the groups where they are
            for k in range(PIVOTS):
                pivot = order[np.minimum(begin[:-1] + k, begin[1:] - 1)][group]
                i = np.flatnonzero((pivot != np.arange(len(d))) & _may(n, place, pivot, np.arange(len(d))))
                yield _pairs(d, pivot[i], i)

    return met.repartition("shingle").sortWithinPartitions("shingle", "digest").mapInArrow(tidy(run), "a long, b long").distinct()


def other_pairs(met: DataFrame, sketches: DataFrame, roots: DataFrame) -> DataFrame:
    """Distinct pairs of members of a shingle's texts that are in different classes, unless sketches differ too much already: these are
    compared where the texts meet, so a pair that is not alike is hardly ever a row."""

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _groups(batches, tuple(OPEN.names)):
            new = np.concatenate([[True], columns[0][1:] != columns[0][:-1]])
            begin, root = np.flatnonzero(new), columns[-1]
            open_ = (np.maximum.reduceat(root, begin) != np.minimum.reduceat(root, begin))[np.cumsum(new) - 1]
            if open_.any():
                yield table(OPEN, **{k: x[open_] for k, x in zip(OPEN.names, columns, strict=True)})

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield table(FOLDED, digest=batch.column("digest"), sketch=[folded(x) for x in batch.column("sketch").to_pylist()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, d, n, place, root, sketch in _groups(batches, (*OPEN.names, "sketch")):
            known = np.array([x is not None for x in sketch])
            bits = np.frombuffer(b"".join(x or bytes(SKETCH // 8) for x in sketch), np.uint64).reshape(len(s), -1)
            i, step = np.arange(len(s)), 1
            while len(i := i[i + step < len(s)]) and len(i := i[s[i] == s[i + step]]):
                may = (root[i] != root[i + step]) & _may(n, place, i, i + step)
                x, y = i[may], i[may] + step
                most = (DENOMINATOR - NUMERATOR) * (n[x].astype(np.int64) + n[y])
                few = (NUMERATOR + DENOMINATOR) * np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64) <= most
                near = few | ~known[x] | ~known[y]
                if near.any():
                    yield _pairs(d, x[near], y[near])
                step += 1

    labelled = met.join(roots.withColumnRenamed("node", "digest"), "digest", "left").select(*BEGINNINGS.names, F.coalesce("root", "digest").alias("root"))
    dealt = labelled.repartition("shingle").sortWithinPartitions("shingle", "digest")
    open_ = settled(dealt.mapInArrow(tidy(several), "shingle long, digest long, n int, place int, root long"), "open")
    own = sketches.filter(F.col("n") <= SHORT).join(open_.select("digest").distinct(), "digest", "left_semi").select("digest", "sketch")
    rows = open_.join(own.mapInArrow(tidy(fold), "digest long, sketch binary"), "digest", "left").select(*OPEN.names, "sketch")
    out = settled(rows.repartition("shingle").sortWithinPartitions("shingle", "digest").mapInArrow(tidy(run), "a long, b long").distinct(), "across")
    dropped(open_)
    return out


def alike(texts: DataFrame, sketches: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs of digests whose whole sets are alike. Sets are made for the texts of pairs whose sketches allow it."""

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = (DENOMINATOR - NUMERATOR) * (batch.column("na").to_numpy() + batch.column("nb").to_numpy())
            few = (NUMERATOR + DENOMINATOR) * differing(batch.column("sketcha").to_pylist(), batch.column("sketchb").to_pylist()) <= most
            yield batch.select(["a", "b"]).filter(pa.array(few))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for a, b, sets in _sets(batch):
                own = [digest(s) for s in sets]
                new = [d not in met and not met.add(d) for d in own]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), batch.column("text").slice(a, b - a)], ["digest", "text"]).filter(pa.array(new, pa.bool_()))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, sets in _sets(batch):
                yield table(SETS, digest=batch.column("digest").slice(a, b - a), members=[s.tobytes() for s in sets])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            keep = []
            for i in range(len(batch)):
                p, q = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (x, y))
                both = np.concatenate([p, q])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(DENOMINATOR * common >= NUMERATOR * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    short = [sketches.select(F.col("digest").alias(k), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"sketch{k}")) for k in ("a", "b")]
    close = settled(pairs.join(short[0], "a").join(short[1], "b").mapInArrow(tidy(possible), "a long, b long"), "close")
    wanted = settled(close.select(F.col("a").alias("digest")).unionByName(close.select(F.col("b").alias("digest"))).distinct(), "wanted")
    held = texts.select("text").mapInArrow(tidy(marked), "digest long, text string").join(wanted, "digest", "left_semi").groupBy("digest").agg(F.any_value("text").alias("text"))
    sets = settled(held.mapInArrow(tidy(whole), "digest long, members binary"), "sets")
    x, y = (sets.select(F.col("digest").alias(k), F.col("members").alias(m)) for k, m in (("a", "x"), ("b", "y")))
    out = settled(close.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(tidy(compared), "a long, b long"), "alike")
    dropped(close, wanted, sets)
    return out


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id, digest) of every row of df, and (node, root) of digests as components() has them."""
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    prints = settled(digests(texts), "digests")
    sketches = settled(prints.groupBy("digest").agg(*(F.any_value(c).alias(c) for c in ("n", "sketch", "fp"))), "sketches")
    met = settled(shared(beginnings(texts, frequent(texts))), "shared")
    linked = fingerprint_pairs(sketches)
    tried = settled(linked.unionByName(first_pairs(met)).distinct(), "first-pairs")
    found = alike(texts, sketches, tried)
    near = components(found)
    across = other_pairs(met, sketches, near)
    more = settled(across.join(tried, ["a", "b"], "left_anti"), "other-pairs")
    dropped(met, tried, linked, across)
    rest = alike(texts, sketches, more)
    dropped(more, sketches)
    return prints.select("id", "digest"), components(found.unionByName(rest))


def representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_bloom: int = MOST_BLOOM) -> DataFrame:
    """df with one row of each class of texts that are alike, or are connected by such: that of the
    smallest id, null after all others; of several of its rows the one with the least set hash, then text.

    Equal sets, empty ones (null and wordless texts) included, are alike. Every row belongs to a class,
    whatever its id. Sets are compared by 64-bit hashes of shingles, equal ones by 64 bits a set. No list
    of a class is gathered; a pair of texts that are not alike is compared once at most in each round.
    A Bloom filter of the ids that some row loses, or that have rows of one set, sends all other rows past the join that
    chooses; its size follows their number, and beyond most_bloom bits it only lets more rows into the join.
    """
    prints, roots = classes(df, id_col, text_col)
    least = prints.groupBy("digest").agg(F.min("id").alias("least"))
    rooted = least.join(roots.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    chosen = rooted.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "digest")).alias("c"))
    own, id_, none, nth = (free_name(df, f"siltstone_{k}") for k in ("own", "id", "none", "nth"))
    of = lambda c: (F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(id_), F.col(c).isNull().alias(none))
    chosen = settled(chosen.select(F.col("c.digest").alias(own), *of("c.least")), "chosen")
    counted = prints.filter("id is not null").groupBy("id", "digest").agg(F.count("*").alias("rows"))
    unsure = counted.join(chosen.filter(~F.col(none)), (F.col("id") == F.col(id_)) & (F.col("digest") == F.col(own)), "left")
    unsure = settled(unsure.filter(F.col(own).isNull() | (F.col("rows") > 1)).select("id").distinct(), "unsure")
    may = keys_held(unsure, F.xxhash64("id"), most_bloom)
    key = F.when(F.col(id_col).cast("long").isNotNull(), F.xxhash64(F.col(id_col).cast("long")))

    def open_(keys: pa.Array) -> np.ndarray:
        return keys.is_null().to_numpy(zero_copy_only=False) | may(keys.fill_null(0).to_numpy(zero_copy_only=False))

    @F.arrow_udf("boolean")
    def past(keys: pa.Array) -> pa.Array:
        return pa.array(~open_(keys), pa.bool_())

    @F.arrow_udf("long")
    def digested(keys: pa.Array, texts: pa.Array) -> pa.Array:
        ask = open_(keys)
        texts, out = texts.filter(pa.array(ask, pa.bool_())).to_pylist(), np.zeros(len(ask), np.int64)
        out[ask] = [digest(s) for a, b in by_bytes(texts, HASHED) for s in shingle_sets(texts[a:b])]
        return pa.array(out, mask=~ask)

    keys = [own, id_, none]
    # not deterministic for the planner, which would else filter on it below the join and so compute it twice, by two workers a task
    asked = df.select("*", digested.asNondeterministic()(key, F.col(text_col)).alias(own), *of(id_col)).filter(F.col(own).isNotNull())
    rows = asked.join(chosen, keys, "left_semi")
    one = rows.withColumn(nth, F.row_number().over(W.partitionBy(*keys).orderBy(text_col))).filter(F.col(nth) == 1).select(*df.columns)
    return df.filter(past(key)).unionByName(one)
