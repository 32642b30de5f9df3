"""Order MinHash fingerprints, in DataFrame functions only.

A text's k-mers are runs of two words, each numbered by how often it has occurred before, so that
all are distinct. One hash function puts them on a circle with SLOTS equal parts; a tuple is made of the two least
k-mers from the begin of each part on, whichever part they lie in. The tuple's k-mers are put in the order in which they stand in
the text and hashed together. Tuples so agree for texts that share k-mers in the same order, which follows edit
distance rather than overlap alone; a text of two k-mers or more has an order in every tuple.

Everything is arrays of 64-bit integers: a k-mer's hash in the upper 33 bits, its place in the lower
31, as many as an array has. An array is sorted, runs of equal hashes give the
occurrence numbers, and a second sort puts the numbered k-mers on the circle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOT_BITS = 6
SLOTS = 1 << SLOT_BITS
PLACE_BITS = 31
PLACE = (1 << PLACE_BITS) - 1
#: Texts of fewer words than one for so many characters are cut into characters, and k-mers are runs of three of these.
WORD_SIZE = 32
#: Bytes of text in a block of consecutive ids, about; one block is sorted by one task.
BLOCK_BYTES = 64 << 20


def bound(value: Column, body) -> Column:
    """body(value), value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def paired(hashes: Column) -> Column:
    """Hashes of neighbours; an array of fewer than two as it is."""
    return bound(hashes, lambda h: F.when(F.size(h) < 2, h).otherwise(F.zip_with(F.slice(h, F.lit(1), F.size(h) - 1), F.slice(h, F.lit(2), F.size(h)), lambda a, b: F.xxhash64(a, b))))


def kmers(text: Column) -> Column:
    """Hash and place of each k-mer, sorted. A text with one word or none is one k-mer."""
    words = F.split(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), "[ \\t-\\r]+")
    hashed = lambda units: F.transform(units, lambda w: F.xxhash64(w))
    characters = paired(paired(hashed(F.split(text, ""))))
    grams = bound(words, lambda w: F.when(F.size(w) * WORD_SIZE < F.length(text), characters).otherwise(paired(hashed(w))))
    return F.sort_array(F.transform(grams, lambda x, i: x.bitwiseAND(F.lit(~PLACE)).bitwiseOR(i.cast("long"))))


def numbered(sorted_: Column) -> Column:
    """K-mers hashed anew with their occurrence numbers, sorted."""

    def of(s: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.shiftright(F.get(s, i), PLACE_BITS) != F.shiftright(F.get(s, i - 1), PLACE_BITS)))
        again = lambda x, t: F.xxhash64(F.shiftright(x, PLACE_BITS), t).bitwiseAND(F.lit(~PLACE)).bitwiseOR(x.bitwiseAND(F.lit(PLACE)))
        run = lambda a, b: F.transform(F.slice(s, a + 1, F.coalesce(b, F.size(s)) - a), again)
        return bound(first, lambda f: F.flatten(F.zip_with(f, F.slice(f, F.lit(2), F.size(f)), run)))

    return F.sort_array(bound(sorted_, of))


def slot(x: Column) -> Column:
    """The part of the circle, from 0."""
    return (F.shiftright(x, 64 - SLOT_BITS) + SLOTS // 2).cast("int")


def tuples(circle: Column) -> Column:
    """SLOTS hashes of 32 bits: the tuple of each part. Parts without a k-mer have that of the next one that has some."""

    def of(s: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (slot(F.get(s, i)) != slot(F.get(s, i - 1))))

        def one(i: Column) -> Column:
            x, y = F.get(s, i), F.get(s, (i + 1) % F.size(s))
            key = lambda z: F.shiftright(z, PLACE_BITS)
            ordered = F.when(x.bitwiseAND(F.lit(PLACE)) <= y.bitwiseAND(F.lit(PLACE)), F.xxhash64(key(x), key(y))).otherwise(F.xxhash64(key(y), key(x)))
            return F.struct(slot(x).alias("slot"), ordered.bitwiseAND(F.lit(0xFFFFFFFF)).alias("said"))

        def spread(made: Column) -> Column:
            parts = F.transform(made, lambda m, j: F.array_repeat(m["said"], m["slot"] - F.when(j == 0, -1).otherwise(F.get(made, j - 1)["slot"])))
            return F.concat(F.flatten(parts), F.array_repeat(F.get(made, F.lit(0))["said"], F.lit(SLOTS - 1) - F.element_at(made, -1)["slot"]))

        return bound(F.transform(begins, one), spread)

    return bound(circle, of)


def signature(text: Column) -> Column:
    """SLOTS integers. Null counts as empty; equal texts have equal signatures."""
    return tuples(numbered(kmers(F.coalesce(text, F.lit("")))))


def as_text(sig: Column) -> Column:
    return F.array_join(F.transform(sig, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of slots with the same tuple."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(SLOTS)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: id_col, fingerprint. Null and wordless texts have the fingerprint
    of the empty word; null ids stay; repeated rows count each; other columns are not read. Texts with hardly any white space
    are compared by runs of three characters."""
    return df.select(id_col, as_text(signature(F.col(text_col))).alias("fingerprint"))


def last_at_most(bounds: list[int], key: Column) -> Column:
    """How many of the ascending bounds are at most key, by bisection."""
    steps, held = [1 << k for k in reversed(range(len(bounds).bit_length()))], F.lit(bounds)
    return F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(F.coalesce(F.get(held, at + step - 1) <= key, F.lit(False)), at + step).otherwise(at))


class Blocks:
    """Consecutive blocks of rows in ascending order of (id, h), null ids first, of about equal numbers of rows: ids are cut at their
    quantiles; ids that fill several quantiles, and null ids, are cut by the hash h beside."""

    def __init__(self, quantiles: list[int], nulls: int, rows: int, blocks: int):
        self.bounds = sorted(set(quantiles))
        self.many = [quantiles.count(b) for b in self.bounds] if len(self.bounds) < len(quantiles) else [1] * len(self.bounds)
        self.null_parts = max(1, -(-nulls * blocks // max(rows, 1)))
        # of each bound: its own id's parts where it has several, then the ids that follow it
        self.first, at = [], self.null_parts + 1
        for n in self.many:
            self.first.append(at)
            at += (n if n > 1 else 0) + 1

    @staticmethod
    def _part(h: Column, n: Column) -> Column:
        return F.least(F.floor((h.cast("double") / 2.0**64 + 0.5) * n).cast("int"), n.cast("int") - 1)

    def of(self, key: Column, h: Column) -> Column:
        null = F.when(key.isNull(), self._part(h, F.lit(self.null_parts)))
        if not self.bounds:
            return null.otherwise(self.null_parts)

        def placed(k: Column) -> Column:
            first, many = F.get(F.lit(self.first), k - 1), F.get(F.lit(self.many), k - 1)
            own = (F.get(F.lit(self.bounds), k - 1) == key) & (many > 1)
            return F.when(k == 0, self.null_parts).when(own, first + self._part(h, many)).otherwise(first + F.when(many > 1, many).otherwise(0))

        return null.otherwise(bound(last_at_most(self.bounds, key), placed))


def with_next(df: DataFrame, derived: dict[str, Column], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """df (id, text) with the derived columns, and next_text and next_<derived> from the row that follows in
    descending order of id; the last is followed by the first. Rows of one id follow each other by the
    hash of their text; null ids come last.

    Rows are cut into blocks, as many as their bytes ask for. Each block is sorted for itself; a copy of the first
    row of the block that follows stands at its end. Only the blocks' bounds and first ids come to the driver.
    """
    spark = df.sparkSession
    ids = df.select("id", F.xxhash64("text").alias("h"))
    size = df.agg(F.count("*").alias("n"), F.count("id").alias("some"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size["bytes"] or 0) // block_bytes))
    quantiles = ids.agg(F.percentile_approx("id", [k / blocks for k in range(1, blocks)], 10 * blocks).alias("q")).first()["q"] if blocks > 1 else None
    cut = Blocks(sorted(quantiles or []), size["n"] - size["some"], size["n"], blocks)
    block = cut.of(F.col("id"), F.col("h"))
    heads = ids.groupBy(block.alias("block")).agg(F.max(F.struct("id", "h")).alias("head")).select("block", "head.*").collect()  # one row a block
    heads.sort(key=lambda r: -r["block"])
    before = [(heads[i - 1]["block"], r["id"], r["h"]) for i, r in enumerate(heads)]  # heads[-1]: the last block is followed by the first
    firsts = spark.createDataFrame(before, "block int, head_id long, head_h long")
    rows = df.withColumn("h", F.xxhash64("text"))
    copies = rows.join(F.broadcast(firsts), F.col("id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h")))  # a row a block
    copies = copies.dropDuplicates(["block"]).withColumn("copy", F.lit(1)).select("block", "copy", "h", *df.columns)
    every = rows.select(block.alias("block"), F.lit(0).alias("copy"), "h", *df.columns).unionByName(copies)
    order = W.partitionBy("block").orderBy("copy", F.desc_nulls_last("id"), F.desc("h"))
    columns = ["text", *derived]
    full = every.withColumns(derived)  # once a row, before the shuffle
    return full.select("copy", "id", *columns, *(F.lead(c).over(order).alias(f"next_{c}") for c in columns)).filter("copy = 0").drop("copy")


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each row of df: id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The edited text has its last floor(n_chars / 3) characters replaced by the
    first as many (or all) of the next document's, ids descending; a document alone is followed by itself.

    Null text is empty. Rows of one id follow each other by their texts' hashes, null ids come last, repeated rows count each; an empty
    table gives no rows; other columns are not read. One shuffle carries text and fingerprint; no Python runs on executors.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    both = with_next(rows, {"sig": signature(F.col("text"))}, block_bytes).select("id", "sig", "next_sig", n.cast("long").alias("n_chars"), edited.alias("edited"))
    both = both.withColumn("edited_sig", signature(F.col("edited")))
    return both.select(
        F.col("id").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("sig")).alias("fingerprint"), as_text(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
