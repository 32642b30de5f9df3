"""What the operators share: the shared folder, cut lineage, words, byte-balanced batches."""

from __future__ import annotations

import atexit
import ctypes
import gc
import sys
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Texts handed to one step of Python work together hold about this many bytes.
BATCH_BYTES = 4 << 20

#: Batches after which a task gives unused memory back.
TRIM_EVERY = 16

#: Spark's setting by which a query's shuffle files go when it ends, rather than when the driver collects its garbage.
TIDY_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: list[tuple[SparkSession, str]] = []
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where a local session has none
    (single-machine tests) is one made and set; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jsc = spark.sparkContext._jsc.sc()
        set_before = jsc.getCheckpointDir()
        if set_before.isDefined():
            return set_before.get()
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="siltstone-")
        spark.sparkContext.setCheckpointDir(found)
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return found


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder; removed when the driver's Python ends."""
    path = f"{shared_dir(spark).rstrip('/')}/siltstone/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_clean)
    _written.append((spark, path))
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def _clean() -> None:
    for spark, path in _written:
        try:
            drop_path(spark, path)
        except Exception:  # gone already, or the session has ended: the rest is the cluster's to clear
            continue


def settled(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read again: lineage ends here, a lost
    executor costs no recomputation, the planner sees the true size, and the shuffle files of the
    write go with its end."""
    spark = df.sparkSession
    path, before = fresh_path(spark, name), spark.conf.get(TIDY_SHUFFLES)
    spark.conf.set(TIDY_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(TIDY_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Removes what settled() wrote for these frames; nothing may read them, or what was made of them, afterwards."""
    for df in frames:
        path = _paths.pop(df, None)
        if path:
            drop_path(df.sparkSession, path)
            _written.remove((df.sparkSession, path))


def utf8_size(text: str | None) -> int:
    return 0 if text is None else len(text) if text.isascii() else len(text.encode())


def by_bytes(texts: list, most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Slices [a, b) of texts with about `most` bytes of UTF-8 each; a longer text is alone."""
    a = total = 0
    for i, t in enumerate(texts):
        n = utf8_size(t)
        if i > a and total + n > most:
            yield a, i
            a, total = i, 0
        total += n
    if a < len(texts):
        yield a, len(texts)


_kept: dict[tuple, object] = {}


def kept(key: tuple, make: Callable):
    """What a Python worker keeps from task to task, one object at a time: another key drops what was there, so stages
    that share a worker do not add up."""
    if key not in _kept:
        cleared()
        _kept[key] = make()
    return _kept[key]


def cleared() -> None:
    """Drops what another operator's tasks left in this Python worker. For operators that keep nothing themselves."""
    if _kept:
        _kept.clear()
        gc.collect()  # encoders and their caches refer to each other
        trimmed()


def tidy(run: Callable) -> Callable:
    """run, a function of batches that keeps nothing from task to task, in a worker that is cleared before and gives memory back now and then."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cleared()
        for i, out in enumerate(run(batches)):
            yield out
            if i % TRIM_EVERY == TRIM_EVERY - 1:
                trimmed()
        trimmed()

    return tidied


def trimmed() -> None:
    """Gives memory that Python, numpy and Arrow no longer use back to the system."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def free_name(df: DataFrame, name: str) -> str:
    """name, with as many underscores after it as make it a new column of df."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch of the schema's columns, cast to its types."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, type=f.type) for f in schema], schema=schema
    )


#: Odd multiplier of the 64-bit mixing steps.
ODD = np.uint64(0x9E3779B97F4A7C15)
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
_is_space = np.zeros(256, bool)
_is_space[[0x20, *range(0x09, 0x0E)]] = True
_low_bytes = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers after which all bits depend on all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings raw[a:b]: eight bytes a step, each step mixed before the next; long ones by
    XXH64. Equal strings have equal hashes; where different ones must never be taken for equal, callers compare bytes."""
    size = ends - starts
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
    out = mixed(eight[starts] & _low_bytes[np.minimum(size, 8)] ^ mixed(size.astype(np.uint64) * ODD))
    for done in range(8, LONG_WORD, 8):
        rest = np.flatnonzero(size > done)
        if not len(rest):
            return out
        out[rest] = mixed(out[rest] * ODD ^ eight[starts[rest] + done] & _low_bytes[np.minimum(size[rest] - done, 8)])
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = xxhash.xxh64_intdigest(raw[starts[i] : ends[i]].tobytes())
    return out


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words from the words' hashes, by doubling: runs of 2, 4, 8 words and so on, each
    mixed from its halves."""
    of, size, out, have = words, 1, None, 0
    while True:
        if width & size:  # the next `size` words of the run
            if out is None:
                out, have = of, size
            else:
                n = len(words) - have - size + 1
                out, have = mixed(out[: max(n, 0)] * ODD + of[have : have + max(n, 0)]), have + size
        if 2 * size > width:
            return out if out is not None else words
        n = max(len(of) - size, 0)
        of, size = mixed(of[:n] * ODD + of[size : size + n] + np.uint64(size)), 2 * size


def word_places(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in bytes, of the maximal runs without ASCII white space (0x20, 0x09-0x0D)."""
    solid = np.zeros(len(raw) + 2, np.int8)
    solid[1:-1] = ~_is_space[raw]
    edge = np.diff(solid)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def text_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts (null: no word) end to end: the bytes; each word's start and end; the words' hashes;
    the number of words before each text, and all."""
    return line_words([t.encode() if t else b"" for t in texts])


def line_words(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text_words() of texts in UTF-8."""
    raw = np.frombuffer(b"\n".join(data), np.uint8)
    starts, ends = word_places(raw)
    first = np.cumsum([0, *(len(d) + 1 for d in data)])
    return raw, starts, ends, word_hashes(raw, starts, ends), np.searchsorted(starts, first)
