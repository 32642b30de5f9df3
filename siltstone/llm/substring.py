"""Substring deduplication by relative Lempel-Ziv parsing.

Every document is a reference block for the documents with larger ids. The index says of each stretch of words that
a block has where in which block it first stands; a document is parsed from left to right into factors: at the first
place that the index knows, the factor is extended as long as the next place continues in the same block at the
next place there. Windows that lie across the end of a factor are looked up like all others, so the next factor
may begin within the last one, and no window is missed where the block or the place in it changes. Factors have
`window` words at least and become duplicate spans; the words that are removed are those of the factors.

The index has two levels. A window's anchor is the least hash of the runs of half its length within it, so equal windows
have equal anchors. A segment is a maximal row of windows with one anchor; the words that it spans are its key, and
segments in two documents or more are factored whole. Only where two different segments have an anchor in common may
they share some windows and not others; of each such segment the first owner's windows are looked up one by one.

Keys are 128-bit BLAKE2b digests of the words themselves, put together by single spaces: the comparison of words is
that of these digests, for which no two different texts are known to agree. Hashes of 64 bits choose anchors
only, and decide what is looked up, not what is found.

Anchors that two ids or more have are gathered in a Bloom filter whose size follows their number. Where it would be larger than
MOST_BLOOM bits, anchors are dealt into parts by their hash, with a filter and a scan each. A false positive costs a row and changes no result.

Only the texts that a join needs are shuffled: a Bloom filter of ids and marks sends the others past it. Beyond MOST_BLOOM bits it lets more texts
through to the join, which changes no result either.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.llm.shared import by_bytes, cleared, dropped, line_words, run_hashes, settled, table, tidy, trimmed

WINDOW = 50
#: Bits of a filter for each anchor in it, and of the largest filter (64 MB): more anchors take more scans.
BLOOM_PER_ANCHOR, MOST_BLOOM = 16, 1 << 29
HASHED = 1 << 19
#: Segments that a task holds before it settles copies among them.
HELD = 1 << 18
#: Parts of an anchor's rows where they are joined by it.
SALTS = 32

ANCHORS = pa.schema([("anchor", pa.int64()), ("id", pa.int64())])
SEGMENTS = pa.schema([*((k, pa.int64()) for k in ("key", "key2", "anchor", "id", "mark", "place", "n", "ref", "ref_place"))])
SEGMENTS_SQL = ", ".join(f"{k} long" for k in SEGMENTS.names)
RUNS = pa.schema([*((k, pa.int64()) for k in ("key", "key2", "id", "mark", "place"))])


def least_of(h: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` consecutive values."""
    out, have = h, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def normal(text: str | None) -> bytes:
    """The words of a text, one space between them."""
    return b" ".join(text.encode().split()) if text else b""


def digest(words: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(words, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def segments(texts: list[str | None], window: int) -> tuple[np.ndarray, ...]:
    """Of each segment of each text: the text's place, the first window, how many windows, the anchor, the first and last byte
    in the texts' normal forms, with those end to end."""
    line = [normal(t) for t in texts]
    raw, starts, ends, words, at = line_words(line)
    raw = raw.tobytes()
    n, half = len(words) - window + 1, max(1, window // 2)
    none = np.empty(0, np.int64)
    if n <= 0:
        return none, none, none, none.view(np.uint64), none, none, raw
    anchor = least_of(run_hashes(words, half), window - half + 1)
    text = np.repeat(np.arange(len(texts)), np.diff(at))
    i = np.flatnonzero(text[:n] == text[window - 1 :])
    if not len(i):
        return none, none, none, none.view(np.uint64), none, none, raw
    a, t = anchor[i], text[i]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (t[1:] != t[:-1])]))
    size = np.diff(np.append(new, len(i)))
    first = i[new]
    return t[new], first - at[t[new]], size, a[new], starts[first], ends[first + size + window - 2], raw


def slots(anchor: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of an anchor in a filter of `bits` bits."""
    return anchor & np.uint64(bits - 1), (anchor >> np.uint64(32)) & np.uint64(bits - 1)


def _marked(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, text): the mark tells rows of one id apart."""
    return df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))


def shared_anchors(rows: DataFrame, window: int) -> DataFrame:
    """Anchors that documents of two ids or more have."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cleared()
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("id").to_numpy(zero_copy_only=False)
            for a, b in by_bytes(texts, HASHED):
                text, _, _, anchor, *_ = segments(texts[a:b], window)
                yield table(ANCHORS, anchor=anchor.view(np.int64), id=ids[a:b][text].astype(np.int64))
        trimmed()

    found = rows.select("id", "text").mapInArrow(find, "anchor long, id long").groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    return settled(found.filter("low < high").select("anchor"), "anchors")


def bloom(anchors: DataFrame, bits: int) -> np.ndarray:
    mask = F.lit(bits - 1)
    bit = F.explode(F.array(F.col("anchor").bitwiseAND(mask), F.shiftrightunsigned("anchor", 32).bitwiseAND(mask))).alias("bit")
    one: Column = F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")
    words = anchors.select(bit).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()  # at most bits / 64 rows
    out = np.zeros(bits // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def holds(filter_: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    """Whether the keys may be among those that the filter was made of; never False for one that is."""
    keys, out = keys.view(np.uint64), np.ones(len(keys), bool)
    for bit in slots(keys, bits):
        out &= (filter_[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def _key(id_: str = "id", mark: str = "mark") -> Column:
    return F.xxhash64(id_, mark)


def keys_held(rows: DataFrame, key: Column, most_bloom: int) -> Callable[[np.ndarray], np.ndarray]:
    """holds() for the keys of rows."""
    bits = min(1 << max(10, (BLOOM_PER_ANCHOR * rows.count()).bit_length()), most_bloom)
    sent = rows.sparkSession.sparkContext.broadcast(bloom(rows.select(key.alias("anchor")), bits))
    return lambda keys: holds(sent.value, bits, keys)


def _needed(rows: DataFrame, may: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Those of rows that a join by id and mark may need, written, so that no task has two Python workers at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may(batch.column("key").to_numpy()), pa.bool_())).drop_columns(["key"])

    return settled(rows.withColumn("key", _key()).mapInArrow(tidy(run), rows.schema), "needed")


def settle_copies(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of SEGMENTS -> those of the smallest id of each key, and the others with that id's first place as reference.
    Any document with a smaller id will do as a reference."""
    every = np.concatenate(held)
    every = every[np.lexsort((every[:, 5], every[:, 4], every[:, 3], every[:, 1], every[:, 0]))]
    same = np.ones(len(every), bool)
    same[1:] = (every[1:, :7] != every[:-1, :7]).any(axis=1)
    every = every[same]  # repeated rows once
    begin = np.ones(len(every), bool)
    begin[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    owner = every[np.flatnonzero(begin)[np.cumsum(begin) - 1]]
    copy = every[:, 3] > owner[:, 3]
    every[:, 7], every[:, 8] = owner[:, 3], owner[:, 5]
    return every[~copy], every[copy]


def segment_rows(rows: DataFrame, anchors: DataFrame, window: int, most_bloom: int) -> DataFrame:
    """SEGMENTS of the documents whose anchor is shared; ref is null where no copy with a smaller id was met in the same task."""
    per_part = max(1, most_bloom // BLOOM_PER_ANCHOR)
    n = anchors.count()
    parts = max(1, -(-n // per_part))
    bits = 1 << max(10, (BLOOM_PER_ANCHOR * -(-n // parts)).bit_length())
    out = None
    for part in range(parts):
        own = anchors.filter(F.pmod(F.shiftrightunsigned("anchor", 16), F.lit(parts)) == part) if parts > 1 else anchors
        sent = rows.sparkSession.sparkContext.broadcast(bloom(own, bits))
        some = rows.mapInArrow(_finder(sent, bits, window, parts, part), SEGMENTS_SQL)
        out = some if out is None else out.unionByName(some)
    return out


def _finder(sent, bits: int, window: int, parts: int, part: int) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        size = 0

        def done() -> Iterator[pa.RecordBatch]:
            for x, known in zip(settle_copies(waiting), (False, True), strict=True):
                if len(x):
                    columns = {k: np.ascontiguousarray(x[:, j]) for j, k in enumerate(SEGMENTS.names)}
                    if not known:
                        columns |= dict.fromkeys(("ref", "ref_place"), pa.nulls(len(x), pa.int64()))
                    yield table(SEGMENTS, **columns)
            waiting.clear()

        for batch in batches:
            held = sent.value
            texts, ids, marks = batch.column("text").to_pylist(), batch.column("id").to_numpy(), batch.column("mark").to_numpy()
            for a, b in by_bytes(texts, HASHED):
                text, place, n, anchor, begin, end, raw = segments(texts[a:b], window)
                keep = np.ones(len(anchor), bool)
                if parts > 1:
                    keep &= (anchor.view(np.int64).astype(np.uint64) >> np.uint64(16)) % np.uint64(parts) == np.uint64(part)
                keep = np.flatnonzero(keep & holds(held, bits, anchor))
                if not len(keep):
                    continue
                key = b"".join(hashlib.blake2b(raw[x:y], digest_size=16).digest() for x, y in zip(begin[keep].tolist(), end[keep].tolist(), strict=True))
                key = np.frombuffer(key, "<i8").reshape(-1, 2)
                t = text[keep]
                zero = np.zeros(len(keep), np.int64)
                waiting.append(np.stack([key[:, 0], key[:, 1], anchor[keep].view(np.int64), ids[a:b][t], marks[a:b][t], place[keep], n[keep], zero, zero], axis=1))
                size += len(keep)
                if size > HELD:
                    yield from done()
                    size = 0
        if waiting:
            yield from done()
        trimmed()

    return find


def _first(rows: DataFrame) -> DataFrame:
    """The least id of each key, one of its places, and the last id."""
    return rows.groupBy("key", "key2").agg(F.min("id").alias("ref"), F.min_by("place", "id").alias("ref_place"), F.max("id").alias("last"))


def _with_first(rows: DataFrame, first: DataFrame, how: str) -> DataFrame:
    """rows with ref and ref_place of their keys. Joined by another key than the sums', so that a hot key's rows can be split."""
    salt = lambda k: F.col(k).bitwiseXOR(F.lit(0x5A5A5A5A5A5A))
    known = first.select(salt("key").alias("k"), F.col("key2").alias("k2"), "ref", "ref_place")
    return rows.withColumn("salted", salt("key")).join(known, (F.col("salted") == F.col("k")) & (F.col("key2") == F.col("k2")), how)


def duplicate_places(df: DataFrame, window: int = WINDOW, most_bloom: int = MOST_BLOOM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, hits): for each id and text that has any, rows of windows (place of the first, n, ref, ref_place) that also
    stand in a document with a smaller id, each window in one of them."""
    rows = _marked(df, id_col, text_col).filter("id is not null and text is not null")
    anchors = shared_anchors(rows, window)
    every = settled(segment_rows(rows, anchors, window, most_bloom), "segments")
    dropped(anchors)
    hit = ["id", "mark", "place", "n", "ref", "ref_place"]
    open_ = every.filter("ref is null").drop("ref", "ref_place")
    first = settled(_first(open_).filter("ref < last"), "first-segments")
    joined = settled(_with_first(open_, first, "left").select("anchor", "key", "key2", *hit), "joined-segments")
    dropped(first)
    copies = joined.filter("id > ref").select(hit)
    owners = joined.filter("ref is null or id = ref")
    # anchors of two different segments
    keys = owners.groupBy(F.col("anchor").alias("two")).agg(F.min("key").alias("a"), F.max("key").alias("b"), F.min("key2").alias("c"), F.max("key2").alias("d")).filter("a <> b or c <> d").select("two", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of"))
    dealt = owners.withColumn("salt", F.pmod(F.xxhash64("id", "place"), F.lit(SALTS)))  # so that a hot anchor's rows meet in SALTS tasks
    wanted = dealt.join(keys, (F.col("anchor") == F.col("two")) & (F.col("salt") == F.col("of")), "left_semi").select("id", "mark", "place", "n")
    wanted = settled(wanted.groupBy("id", "mark").agg(F.collect_set(F.struct("place", "n")).alias("rows")), "wanted")  # at most a text's own segments

    def singly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, m, text, parts in zip(*(batch.column(c).to_pylist() for c in ("id", "mark", "text", "rows")), strict=True):
                words = normal(text).split(b" ")
                ends = np.cumsum([len(w) + 1 for w in words])
                line, place = b" ".join(words), np.concatenate([np.arange(r["place"], r["place"] + r["n"]) for r in parts])
                begin, end = (ends[place] - [len(words[p]) + 1 for p in place.tolist()]).tolist(), (ends[place + window - 1] - 1).tolist()
                key = np.frombuffer(b"".join(hashlib.blake2b(line[x:y], digest_size=16).digest() for x, y in zip(begin, end, strict=True)), "<i8").reshape(-1, 2)
                yield table(RUNS, key=np.ascontiguousarray(key[:, 0]), key2=np.ascontiguousarray(key[:, 1]), id=np.full(len(place), i), mark=np.full(len(place), m), place=place)
        trimmed()

    needed = _needed(rows, keys_held(wanted, _key(), most_bloom))
    texts = needed.join(wanted.withColumnsRenamed({"id": "i", "mark": "m"}), (F.col("id") == F.col("i")) & (F.col("mark") == F.col("m"))).select("id", "mark", "text", "rows")
    runs = settled(texts.mapInArrow(singly, "key long, key2 long, id long, mark long, place long"), "runs")
    dropped(wanted, needed)
    found = _with_first(runs, _first(runs).filter("ref < last"), "inner").filter("id > ref").withColumn("n", F.lit(1).cast("long")).select(hit)
    hits = every.filter("ref is not null").select(hit).unionByName(copies).unionByName(found).repartition("id", "mark")
    one = hits.groupBy("id", "mark", "place").agg(F.max("n").alias("n"), F.min_by("ref_place", "ref").alias("there"), F.min("ref").alias("ref"))  # of repeated rows, each place once
    out = settled(one.groupBy("id", "mark").agg(F.collect_list(F.struct("place", "n", "ref", F.col("there").alias("ref_place"))).alias("hits")), "hits")
    dropped(every, joined, runs)
    return out


def parse(hits: list[tuple[int, int, int, int]], window: int) -> list[tuple[int, int, int, int]]:
    """Factors (first word, words, block, first word there) of a document from its rows of windows (first, n, ref, ref_place):
    greedily, each as long as the next window continues in the same block at the next place."""
    out: list[list[int]] = []
    for place, n, ref, there in sorted(hits):
        if out and (f := out[-1])[2] == ref and f[3] - f[0] == there - place and f[0] + f[1] >= place:
            f[1] = max(f[1], place + n - f[0])
        elif out and place + n <= out[-1][0] + out[-1][1]:
            continue  # within the last factor
        else:
            out.append([place, n, ref, there])
    return [(a, n + window - 1, ref, there) for a, n, ref, there in out]


def _kept(words: list[bytes], factors: list[tuple[int, int, int, int]]) -> list[bytes]:
    out, at = [], 0
    for a, n, _, _ in factors:
        out += words[at:a]
        at = max(at, a + n)
    return out + words[at:] if factors else words


def _apply(df: DataFrame, window: int, most_bloom: int, id_col: str, text_col: str, make, schema: pa.Schema, sql: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """make(text, words, factors) for each row; columns named in carry pass through."""
    hits = duplicate_places(df, window, most_bloom, id_col, text_col).withColumnsRenamed({"id": "hit_id", "mark": "hit_mark"})
    may = keys_held(hits, _key("hit_id", "hit_mark"), most_bloom)
    along = [f"c{i}" for i in range(len(carry))]
    rows = _marked(df, id_col, text_col) if not carry else df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"), *(F.col(c).alias(a) for c, a in zip(carry, along, strict=True)))
    joined = _needed(rows, may).join(hits, (F.col("id") == F.col("hit_id")) & (F.col("mark") == F.col("hit_mark")), "left").select("id", "text", "hits", *along)
    sql = ", ".join([sql, *(f"{a} {df.schema[c].dataType.simpleString()}" for c, a in zip(carry, along, strict=True))])

    def one(batch: pa.RecordBatch, hits: pa.Array | None) -> pa.RecordBatch:
        texts, out = batch.column("text"), []
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            factors = []
            if hits is not None and hits[i].is_valid:
                h = hits[i].values
                factors = parse(list(zip(*(h.field(k).to_pylist() for k in ("place", "n", "ref", "ref_place")), strict=True)), window)
            out.append(make(text, (text or "").encode().split(), factors))
        columns = dict(zip(schema.names[1:], map(list, zip(*out, strict=True)), strict=True)) if out else {k: [] for k in schema.names[1:]}
        made = table(schema, id=batch.column("id"), **columns)
        return pa.RecordBatch.from_arrays([*made.columns, *(batch.column(a) for a in along)], names=[*schema.names, *along])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield one(batch, batch.column("hits"))

    def past(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield one(batch.filter(pa.array(~may(batch.column("key").to_numpy()), pa.bool_())), None)

    found = joined.mapInArrow(met, sql).unionByName(rows.withColumn("key", _key()).mapInArrow(past, sql))
    return found.select(F.col("id").alias(id_col), *schema.names[1:], *(F.col(a).alias(c) for c, a in zip(carry, along, strict=True)))


DIGEST = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
SPAN = ("start", "words", "ref", "ref_start")
TEXT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("spans", pa.list_(pa.struct([(k, pa.int64()) for k in SPAN])))])


def deduplicate(df: DataFrame, window: int = WINDOW, most_bloom: int = MOST_BLOOM, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of df: id_col, n_words, n_removed, kept (the text; where words were
    removed, those left, joined by single spaces; null for null), spans (first word, words,
    reference id, first word there) in the text's order, and the columns named in carry.

    Words are runs without ASCII white space. Null and empty texts and texts of fewer than `window`
    words lose nothing. Rows with a null id are no references and lose nothing. Rows of one id are
    one document as references and lose nothing to each other; repeated rows lose the same. A span's words stand
    in the reference from the place it names (where the reference's id has several texts, a span may run on from one into another); any smaller id may be the reference. An empty
    table gives no rows; columns not carried are not read. Copies of segments are reduced within tasks before they
    are shuffled, then by key; the join back may be split by key. Memory: a task's HELD segments; one document's words and hits.
    """

    def make(text, words, factors):
        kept = _kept(words, factors)
        return len(words), len(words) - len(kept), text if len(kept) == len(words) else b" ".join(kept).decode(), [dict(zip(SPAN, f, strict=True)) for f in factors]

    return _apply(df, window, most_bloom, id_col, text_col, make, TEXT, "id long, n_words long, n_removed long, kept string, spans array<struct<start: long, words: long, ref: long, ref_start: long>>", carry)


def deduplicate_digests(df: DataFrame, window: int = WINDOW, most_bloom: int = MOST_BLOOM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """deduplicate() with a digest for the text: id_col, n_words, n_removed, kept_sha256 (kept words joined by one space)."""

    def make(_, words, factors):
        kept = _kept(words, factors)
        return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()

    return _apply(df, window, most_bloom, id_col, text_col, make, DIGEST, "id long, n_words long, n_removed long, kept_sha256 string")
