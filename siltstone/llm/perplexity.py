"""Quality rules: plain counts of each text, and n-gram perplexity bands.

The model is an interpolated modified Kneser-Ney model of order four over symbols. A letter (of any script, with
its marks) or a digit is a symbol, letters in lower case, digits all alike; what stands between two of them is one
symbol too: a blank, a line end, or a class of the other characters in it, repeats and blanks aside. Marks strewn
among words so cost what they are worth and are not averaged away by the likely characters that come with them.

Spark counts the n-grams of all texts, the continuations of the lower orders, and computes the probabilities and
back-off weights by joins; n-grams of the highest order that occur once are left to the back-off. The model grows
with the corpus. It is kept as 64-bit hashes in ascending order beside logarithms, found by bisection, and dealt
into shards of at most MOST_ENTRIES entries by the two symbols before the predicted one: every prediction
needs the entries of one shard, and those of the two lowest orders, which all shards hold. With one shard
texts are scored in one scan, with more in one scan a shard, whose sums are added.

A document's perplexity is the exponential of its negative log-probability divided by the number of predicted
symbols. A document is outside when its logarithm lies beyond the upper or the lower bound of its language's band. The band is drawn over
the distinct texts that pass the plain rules, so that copies do not count: the shortest interval that holds
half of them is their core, and what is within a few deviations of the core gives a median and a robust
deviation, of which the band has a number to either side. Junk moves neither while it is under half of a
language's distinct texts.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import ODD, by_bytes, cleared, free_name, mixed, run_hashes, settled, table, text_words, tidy, trimmed

ORDER, BITS = 4, 21
#: N-grams of the highest order that occur less often are left to the back-off.
LEAST_COUNT = 2
#: Entries of one shard of the model, of 12 bytes each.
MOST_ENTRIES = 1 << 23
#: Symbols: before a text, line end, blank, digit; classes of other characters follow the code points.
EDGE, LINE, BLANK, DIGIT = 1, 10, 32, 48
FIRST_CLASS, CLASSES = 0x110000, 0xF0000
LOW = (1 << BITS) - 1
#: The symbols that count as such.
MARKS = "#*$%&|<>"
HASHED = 1 << 18
#: N-grams that a task holds before it adds them up, and distinct ones before it passes them on.
WAITING, PASSED_ON = 1 << 19, 1 << 18

FEWEST_WORDS, MOST_REPEATED = 50, 50
#: Half the width of a band, in robust standard deviations (interquartile range / 1.349), and at least.
DEVIATIONS, LEAST_HALF = 6.0, 0.15
#: The core is sought among so many quantiles and their halves; what is so many of its deviations away is not of it.
QUANTILES, NEAR_CORE = 200, 3.0

GRAMS = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("n", pa.int64())])
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCORES = pa.schema([*((k, pa.int64()) for k in COUNTS), ("predicted", pa.int64()), ("log_sum", pa.float64())])
SCORES_SQL = ", ".join([*(f"{k}: long" for k in (*COUNTS, "predicted")), "log_sum: double"])

_classes: tuple[np.ndarray, np.ndarray] | None = None


def characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point whether it is of a word (letter, digit, mark on a letter), and whether it is white space."""
    global _classes
    if _classes is None:
        every = lambda of: np.fromiter((of(chr(i)) for i in range(0x110000)), bool, 0x110000)
        _classes = every(lambda c: c.isalnum() or unicodedata.category(c)[0] == "M"), every(str.isspace)
    return _classes


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of texts, ORDER - 1 edges before each, and the number of symbols with edges before each text, and all."""
    word, space = characters()
    lower = [t.lower() if t else "" for t in texts]
    pad = "\n" * (ORDER - 1)
    code = np.frombuffer((pad + pad.join(lower)).encode("utf-32-le"), np.uint32).astype(np.int64)
    first = np.cumsum([0, *(len(t) + ORDER - 1 for t in lower)])
    edge = np.zeros(len(code), bool)
    for k in range(ORDER - 1):
        edge[first[:-1] + k] = True
    code[(code >= 0x30) & (code < 0x3A)] = DIGIT
    code[edge] = EDGE
    other = ~word[code] & ~edge
    begin = other & ~np.concatenate([[False], other[:-1]])
    run = np.cumsum(begin) - 1
    solid = other & ~space[code]
    solid[1:] &= code[1:] != code[:-1]
    runs = int(begin.sum())
    some = np.flatnonzero(solid)
    kind = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(code[some].astype(np.uint64)))])
    upto = np.searchsorted(some, np.append(np.flatnonzero(begin), len(code)))
    kinds, full = np.diff(kind[upto]), np.diff(upto) > 0
    lines = np.bincount(run[np.flatnonzero(other & (code == LINE))], minlength=runs) > 0
    code[begin] = np.where(full, FIRST_CLASS + (mixed(kinds) % np.uint64(CLASSES)).astype(np.int64), np.where(lines, LINE, BLANK))
    keep = ~other | begin
    return code[keep], np.concatenate([[0], np.cumsum(keep)])[first]


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-gram that ends at each symbol of each text as two numbers, two symbols in each (before a text stand edges),
    and the number of them before each text, and all."""
    line, at = symbols(texts)
    own = line[ORDER - 1 :] != EDGE
    pair = line[:-1] << BITS | line[1:]
    sizes = np.diff(at) - (ORDER - 1)
    return pair[: len(own)][own], pair[2:][own], np.concatenate([[0], np.cumsum(sizes)])


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that sorts the keys, where in it each distinct key begins, and how often it is there."""
    order = np.argsort(key)
    ascending = key[order]
    begin = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), bool), ascending[1:] != ascending[:-1]]))
    return order, begin, np.diff(np.append(begin, len(key)))


def key_of(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """The hash of n-grams of any order; shorter ones have zeros before them."""
    return mixed(mixed(hi.astype(np.uint64) + ODD) + lo.astype(np.uint64))


def context(hi, lo):
    """The n-gram without its last symbol."""
    return hi >> BITS, (hi & LOW) << BITS | lo >> BITS


def suffix(hi, lo, order: int):
    """The n-gram without its first symbol."""
    return (hi & LOW if order == 4 else hi * 0), (lo & LOW if order == 2 else lo * 0 if order == 1 else lo)


def counted(df: DataFrame, text_col: str) -> DataFrame:
    """(hi, lo, n) over all texts: tasks add up what they meet, Spark adds up the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def added() -> tuple:
            key, hi, lo, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order, begin, _ = distinct(key)
            first = order[begin]
            return key[first], hi[first], lo[first], np.add.reduceat(n[order], begin) if len(n) else n

        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in by_bytes(texts, HASHED):
                hi, lo, _ = grams(texts[a:b])
                key = key_of(hi, lo)
                order, begin, n = distinct(key)
                first = order[begin]
                held.append((key[first], hi[first], lo[first], n))
                size += len(first)
                if size > WAITING:
                    held = [added()]
                    size = len(held[0][0])
                    if size > PASSED_ON:
                        yield table(GRAMS, hi=held[0][1], lo=held[0][2], n=held[0][3])
                        held, size = [], 0
        if held:
            _, hi, lo, n = added()
            yield table(GRAMS, hi=hi, lo=lo, n=n)

    rows = df.select(F.col(text_col).alias("text")).filter("text is not null")
    return rows.mapInArrow(tidy(run), "hi long, lo long, n long").groupBy("hi", "lo").agg(F.sum("n").alias("n"))


def discounts(having: dict[int, int]) -> tuple[float, float, float]:
    """Discounts of counts 1, 2, and 3 or more, from how many n-grams have counts 1 to 4."""
    c = [having.get(k, 0) for k in (1, 2, 3, 4)]
    y = c[0] / (c[0] + 2 * c[1]) if c[0] + c[1] else 0.5
    out = [k - (k + 1) * y * c[k] / c[k - 1] if c[k - 1] else k * 0.5 for k in (1, 2, 3)]
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), out, strict=True))


def _two(hi: Column, lo: Column, what: str, order: int) -> tuple[Column, Column]:
    low = F.lit(LOW)
    if what == "context":
        return F.shiftrightunsigned(hi, BITS), F.shiftleft(hi.bitwiseAND(low), BITS).bitwiseOR(F.shiftrightunsigned(lo, BITS))
    zero = F.lit(0).cast("long")
    return (hi.bitwiseAND(low) if order == 4 else zero), (zero if order == 1 else lo.bitwiseAND(low) if order == 2 else lo)


def level(counts: DataFrame, below: DataFrame | None, order: int, least: int, alphabet: int) -> tuple[DataFrame, DataFrame]:
    """Probabilities (hi, lo, p) of the n-grams of one order that occur `least` times or more, and back-off weights (hi,
    lo, w) of their contexts, from counts (hi, lo, n) and the probabilities below."""
    having = {r["c"]: r["k"] for r in counts.groupBy(F.least("n", F.lit(5)).alias("c")).agg(F.count("*").alias("k")).collect()}  # five rows at most
    one, two, more = discounts(having)
    cut = F.when(F.col("n") == 1, one).when(F.col("n") == 2, two).otherwise(more)
    hi, lo = F.col("hi"), F.col("lo")
    (ch, cl), (sh, sl) = _two(hi, lo, "context", order), _two(hi, lo, "suffix", order)
    own = counts.select("hi", "lo", "n", (F.col("n") - cut).alias("rest"), ch.alias("ch"), cl.alias("cl"), sh.alias("sh"), sl.alias("sl"))
    total, mass = F.sum("n"), F.sum(F.when(F.col("n") >= least, F.col("rest")).otherwise(0.0))
    stats = settled(own.groupBy("ch", "cl").agg(total.alias("total"), F.greatest(1 - mass / total, F.lit(1e-12)).alias("w")), "contexts")
    joined = own.filter(F.col("n") >= least).join(stats, ["ch", "cl"])
    if below is None:
        probs = joined.select("hi", "lo", (F.col("rest") / F.col("total") + F.col("w") / alphabet).alias("p"))
    else:
        lower = below.select(F.col("hi").alias("sh"), F.col("lo").alias("sl"), F.col("p").alias("q"))
        probs = joined.join(lower, ["sh", "sl"]).select("hi", "lo", (F.col("rest") / F.col("total") + F.col("w") * F.col("q")).alias("p"))
    return settled(probs, "probabilities"), stats.select(F.col("ch").alias("hi"), F.col("cl").alias("lo"), "w")


class Shard:
    """Sorted hashes of n-grams and of contexts, and their log-probabilities and logarithms of back-off weights."""

    def __init__(self, grams: tuple, weights: tuple, floor: float, shard: int, shards: int):
        self.grams, self.weights = (self._sorted(*x) for x in (grams, weights))
        self.floor, self.shard, self.shards = np.float32(floor), shard, shards

    @staticmethod
    def _sorted(hi: np.ndarray, lo: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = key_of(hi, lo)
        at = np.argsort(key)
        return key[at], np.log(value[at]).astype(np.float32)

    @staticmethod
    def _find(held: tuple[np.ndarray, np.ndarray], key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, values = held
        if not len(keys):
            return np.zeros(len(key), bool), np.zeros(len(key), np.float32)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return keys[at] == key, values[at]

    def log_prob(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Of each n-gram's last symbol after the others; 0 where that is another shard's."""
        out, todo = np.zeros(len(hi), np.float32), np.arange(len(hi))
        if self.shards > 1:
            todo = np.flatnonzero(shard_of(hi, lo) % np.uint64(self.shards) == np.uint64(self.shard))
            hi, lo = hi[todo], lo[todo]
        for order in range(ORDER, 0, -1):
            there, value = self._find(self.grams, key_of(hi, lo))
            out[todo[there]] += value[there]
            todo, hi, lo = todo[~there], hi[~there], lo[~there]
            if not len(todo):
                return out
            if order > 1:
                known, weight = self._find(self.weights, key_of(*context(hi, lo)))
                out[todo[known]] += weight[known]
            hi, lo = suffix(hi, lo, order)
        out[todo] += self.floor
        return out


def shard_of(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """By the two symbols before the last."""
    return mixed(context(hi, lo)[1].astype(np.uint64)) >> np.uint64(33)


def train(df: DataFrame, text_col: str = "text", least: int = LEAST_COUNT, most_entries: int = MOST_ENTRIES) -> list[Broadcast]:
    """The model of all texts of df, in shards. The driver holds one shard at a time."""
    spark = df.sparkSession
    counts = [settled(counted(df, text_col), "grams")]
    for order in range(ORDER, 1, -1):  # how many symbols an n-gram continues
        hi, lo = _two(F.col("hi"), F.col("lo"), "suffix", order)
        counts.append(settled(counts[-1].groupBy(hi.alias("hi"), lo.alias("lo")).agg(F.count("*").alias("n")), "continued"))
    alphabet = counts[-1].count() + 1
    below, entries = None, []
    for order in range(1, ORDER + 1):
        below, weights = level(counts[ORDER - order], below, order, least if order == ORDER else 1, alphabet)
        entries += [(True, order, below.withColumnRenamed("p", "value")), (False, order - 1, weights.withColumnRenamed("w", "value"))]
    floor = entries[1][2].first()
    floor = float(np.log((floor["value"] if floor else 1.0) / alphabet))
    shards = max(1, -(-sum(t.count() for _, _, t in entries) // most_entries))
    return [spark.sparkContext.broadcast(_collected(entries, floor, s, shards)) for s in range(shards)]


def _collected(entries: list[tuple[bool, int, DataFrame]], floor: float, shard: int, shards: int) -> Shard:
    parts: dict[bool, list[tuple]] = {True: [], False: []}
    for is_gram, order, held in entries:
        if shards > 1 and order + (not is_gram) > 2:  # only what predictions of this shard can ask for
            pair = _two(F.col("hi"), F.col("lo"), "context", order)[1] if is_gram else F.col("lo")
            held = held.filter(_of_shard(pair, shard, shards))
        got = held.select("hi", "lo", "value").toArrow()
        parts[is_gram].append(tuple(got.column(c).to_numpy() for c in ("hi", "lo", "value")))
    return Shard(*(tuple(np.concatenate(x) for x in zip(*parts[k], strict=True)) for k in (True, False)), floor, shard, shards)


def _of_shard(pair: Column, shard: int, shards: int) -> Column:
    @F.arrow_udf("boolean")
    def own(pair: pa.Array) -> pa.Array:
        return pa.array((mixed(pair.to_numpy().astype(np.uint64)) >> np.uint64(33)) % np.uint64(shards) == np.uint64(shard))

    return own(pair)


_spaces = np.zeros(256, bool)
_spaces[[0x20, *range(0x09, 0x0E)]] = True
_marks = np.zeros(256, bool)
_marks[[ord(c) for c in MARKS]] = True


def dup_lines(text: str | None) -> int:
    """Lines that have a word and equal an earlier one."""
    seen: set[str] = set()
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")] if text and "\n" in text else []
    seen.update(lines)
    return len(lines) - len(seen)


def plain_counts(texts: list[str | None]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text (null: zeros). Windows whose hashes are
    equal are compared by their words."""
    raw, starts, ends, words, at = text_words(texts)
    first = np.cumsum([0, *(len(t.encode()) + 1 if t else 1 for t in texts)])
    bytes_at = np.minimum(first, len(raw))
    total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[bytes_at])
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    out = {"n_words": np.diff(at), "word_chars": total(~_spaces[raw] & ((raw & 0xC0) != 0x80)), "n_symbols": total(_marks[raw])}
    out["n_dup_lines"] = np.array([dup_lines(t) for t in texts], np.int64)
    repeated = np.zeros(len(words), bool)
    n = len(words) - 2
    if n > 0:
        i = np.flatnonzero(doc[:n] == doc[2:])
        key = mixed(run_hashes(words, 3)[i] + doc[i].astype(np.uint64) * ODD)
        order, _, times = distinct(key)
        often = np.zeros(len(key), bool)
        often[order] = np.repeat(times > 1, times)
        i = i[often]
        line = raw.tobytes()
        own = [(d, *line[a:b].split()) for d, a, b in zip(doc[i].tolist(), starts[i].tolist(), ends[i + 2].tolist(), strict=True)]
        found = Counter(own)
        i = i[np.fromiter((found[x] > 1 for x in own), bool, len(own))]
        for k in range(3):
            repeated[i + k] = True
    out["n_repeat_words"] = np.bincount(doc[repeated], minlength=len(texts))
    return out


def log_sums(texts: list[str | None], shard: Shard) -> tuple[np.ndarray, np.ndarray]:
    """Predicted symbols of each text, and the sum of their log-probabilities."""
    hi, lo, at = grams(texts)
    order, begin, n = distinct(key_of(hi, lo))
    value = np.empty(len(order))
    value[order] = np.repeat(shard.log_prob(hi[order[begin]], lo[order[begin]]), n)
    return np.diff(at), np.diff(np.concatenate([[0.0], np.cumsum(value)])[at])


def scored(df: DataFrame, model: list[Broadcast], text_col: str) -> tuple[DataFrame, str]:
    """df with one more column, a struct of SCORES, and its name. The first shard's sums come with the counts; those of the
    others are taken from the distinct texts and added by the texts' digests."""

    def of(sent: Broadcast) -> Column:
        @F.arrow_udf(f"struct<{SCORES_SQL}>")
        def said(text: pa.Array) -> pa.Array:
            cleared()
            texts, parts = text.to_pylist(), []
            for a, b in by_bytes(texts, HASHED):
                predicted, total = log_sums(texts[a:b], sent.value)
                counts = plain_counts(texts[a:b]) if sent.value.shard == 0 else dict.fromkeys(COUNTS, np.zeros(b - a, np.int64))
                parts.append(table(SCORES, predicted=predicted, log_sum=total, **counts).to_struct_array())
            trimmed()
            return pa.concat_arrays(parts) if parts else pa.array([], pa.struct(list(SCORES)))

        return said.asNondeterministic()(F.col(text_col))  # so that a filter on it stays above it

    name = free_name(df, "siltstone_scores")
    out = df.withColumn(name, of(model[0]))
    if len(model) > 1:
        key = free_name(df, "siltstone_text")
        texts = df.select(F.col(text_col)).filter(F.col(text_col).isNotNull()).distinct()
        rest = [texts.select(F.sha2(F.col(text_col), 256).alias(key), of(b)["log_sum"].alias("more")) for b in model[1:]]
        more = rest[0]
        for r in rest[1:]:
            more = more.unionByName(r)
        more = settled(more.groupBy(key).agg(F.sum("more").alias("siltstone_more")), "sums").withColumnRenamed("siltstone_more", free_name(df, "siltstone_more"))
        extra = free_name(df, "siltstone_more")
        out = out.withColumn(key, F.sha2(F.col(text_col), 256)).join(more, key, "left")
        out = out.withColumn(name, F.col(name).withField("log_sum", F.col(name)["log_sum"] + F.coalesce(extra, F.lit(0.0)))).select(*df.columns, name)
    return out, name


def bands(passing: DataFrame, deviations: float, least_half: float) -> DataFrame:
    """(of, middle, half): the band of each language in log-probabilities a symbol, from one row for each distinct text (lang,
    text_key, x). Aggregates by language; nothing is gathered but quantiles."""
    texts = settled(passing.groupBy(F.col("lang").alias("of"), "text_key").agg(F.min("x").alias("x")), "distinct")
    q = F.percentile_approx("x", [i / QUANTILES for i in range(QUANTILES + 1)], 10_000)
    halves = F.transform(F.sequence(F.lit(0), F.lit(QUANTILES // 2)), lambda i: F.struct((F.get("q", i + QUANTILES // 2) - F.get("q", i)).alias("width"), F.get("q", i).alias("low")))
    core = texts.groupBy(F.col("of").alias("core_of")).agg(q.alias("q")).select("core_of", F.array_min(halves).alias("core"))
    reach = F.greatest(NEAR_CORE * F.col("core.width") / 1.349, F.lit(least_half))
    near = texts.join(core, F.col("of").eqNullSafe(F.col("core_of"))).filter(F.abs(F.col("x") - F.col("core.low") - F.col("core.width") / 2) <= reach)
    quartiles = near.groupBy("of").agg(F.percentile_approx("x", [0.25, 0.5, 0.75], 10_000).alias("q"))
    return quartiles.select("of", F.col("q")[1].alias("middle"), F.greatest(F.lit(deviations) * (F.col("q")[2] - F.col("q")[0]) / 1.349, F.lit(least_half)).alias("half"))


def _judged(df: DataFrame, columns: list[str], text_col: str, lang_col: str, deviations: float, least_half: float, fewest_words: int, most_repeated: int, most_entries: int) -> tuple[DataFrame, str]:
    """The named columns of df beside a struct of counts and verdict, and its name. Scored rows are written once."""
    model = train(df, text_col, most_entries=most_entries)
    full, name = scored(df, model, text_col)
    s = F.col(name)
    failed = (s["n_words"] < fewest_words) | (100 * s["n_repeat_words"] > most_repeated * s["n_words"])
    x = s["log_sum"] / F.greatest(s["predicted"], F.lit(1))
    facts = F.struct(*(s[k].alias(k) for k in COUNTS), failed.alias("base_failed"), x.alias("x"), F.xxhash64(text_col).alias("text_key"), F.col(lang_col).cast("string").alias("lang"))
    # a second projection, so that the struct is computed before it is taken apart
    held = settled(full.withColumn(name, facts).select(*columns, name), "scores")
    # written, so that the planner knows how few they are and does not shuffle the rows to them
    drawn = settled(bands(held.select(f"{name}.*").filter("not base_failed"), deviations, least_half), "bands").select(F.struct("of", "middle", "half").alias(free_name(df, "siltstone_band")))
    band = F.col(free_name(df, "siltstone_band"))
    return held.join(drawn, F.col(name)["lang"].eqNullSafe(band["of"]), "left"), name


def quality_rules(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", deviations: float = DEVIATIONS, least_half: float = LEAST_HALF,
    fewest_words: int = FEWEST_WORDS, most_repeated: int = MOST_REPEATED, most_entries: int = MOST_ENTRIES,
) -> DataFrame:
    """One row for each row of df: id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, perplexity (a predicted symbol), lower and upper (the language's band).

    base_failed: fewer than `fewest_words` words, or over `most_repeated` percent of them in repeated
    three-word windows. kept: not base_failed and perplexity within the band. Null and empty texts have no
    words and fail; their perplexity is 1. A null language is a language of its own; a language
    without a passing document has no band, and none of its documents is kept. Null ids stay, repeated
    rows count each, an empty table gives no rows, other columns are not read. Equal texts have equal
    perplexity, and count once for the band. Quantiles are approximate to 1 in 10,000 ranks, the core's ends to 1 in 200. Whole texts are read, in steps of
    about HASHED bytes; nothing but sums and one row a document is shuffled or kept. Junk that is half of a language's distinct
    passing texts or more cannot be told from the rest by its share.
    """
    joined, name = _judged(df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col), F.col(lang_col)), [id_col], text_col, lang_col, deviations, least_half, fewest_words, most_repeated, most_entries)
    s, band = F.col(name), F.col(joined.columns[-1])
    bounds = [F.exp(-band["middle"] - band["half"]).alias("lower"), F.exp(-band["middle"] + band["half"]).alias("upper")]
    return joined.select(id_col, *(s[k].alias(k) for k in (*COUNTS, "base_failed")), _kept(s, band).alias("kept"), F.exp(-s["x"]).alias("perplexity"), *bounds)


def _kept(s: Column, band: Column) -> Column:
    return ~s["base_failed"] & F.coalesce(F.abs(s["x"] - band["middle"]) <= band["half"], F.lit(False))


def passing(df: DataFrame, text_col: str = "text", lang_col: str = "lang", most_entries: int = MOST_ENTRIES) -> DataFrame:
    """The rows of df, with all their columns, that quality_rules() keeps; decided row by row, whatever the ids. Texts are
    not shuffled: rows are written once beside their scores. Cases are those of quality_rules()."""
    joined, name = _judged(df, df.columns, text_col, lang_col, DEVIATIONS, LEAST_HALF, FEWEST_WORDS, MOST_REPEATED, most_entries)
    return joined.filter(_kept(F.col(name), F.col(joined.columns[-1]))).select(*df.columns)
