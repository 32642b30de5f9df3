"""The symbol graph: names resolved to symbols of the same repository, and one symbol's neighbourhood."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.paths import fq_name, fq_path, fq_symbol, snippet
from siltstone.runtime import checkpointed
from siltstone.schema import RELATIONSHIPS

#: So many names at most go to all tasks, more are joined by name; and about so many references go to one task.
BROADCAST, TASK = 1_000_000, 250_000

#: Buckets of a neighbourhood: relationship, then as seen from the symbol and from the other end.
BUCKETS = {"imports": ("imports", "importedBy"), "calls": ("calls", "calledBy"), "extends": ("extends", "extendedBy"), "implements": ("implements", "implementedBy")}


def _named(records: DataFrame) -> DataFrame:
    named = records.filter(F.col("symbol_name").isNotNull() & (F.col("symbol_name") != ""))
    return named.withColumn("file_path", F.coalesce("file_path", F.lit(""))).withColumn("fq", fq_symbol(F.col("repo"), F.col("file_path"), F.col("symbol_name")))


def _names():
    """A symbol is found by its whole name and by what follows its last dot."""
    return F.array_distinct(F.array("symbol_name", F.substring_index("symbol_name", ".", -1)))


def name_index(records: DataFrame) -> DataFrame:
    """(repo, name, fq), distinct."""
    return _named(records).select("repo", F.explode(_names()).alias("name"), "fq").distinct()


def references(records: DataFrame) -> DataFrame:
    """(repo, fq, file_path, symbol_name, relationship, name), distinct within a record; records of one full name may say the same."""
    columns = {"imports": "imports", "calls": "calls", "extends": "extends_symbols", "implements": "implements_symbols"}
    lists = F.array(*(F.struct(F.lit(rel).alias("relationship"), F.array_distinct(F.coalesce(F.col(columns[rel]), F.array().cast("array<string>"))).alias("names")) for rel in RELATIONSHIPS))
    each = _named(records).select("repo", "fq", "file_path", "symbol_name", F.explode(lists).alias("r"))
    return each.select("repo", "fq", "file_path", "symbol_name", "r.relationship", F.explode("r.names").alias("name"))


class Resolved(NamedTuple):
    #: references() whose name is in the index, with candidates (how many other symbols bear it) and target (fq, at), the only one, else null.
    rows: DataFrame
    #: How many of these can be unique, and how many ambiguous, at most.
    unique: int
    ambiguous: int


def resolved_references(records: DataFrame) -> Resolved:
    """The references that the index knows.

    The index is reduced to a count and its two ends before the join: with two symbols, one of them the
    referring one, the other end is the target. So a name borne by thousands is one row, and the join
    never pairs references with candidates. Of the index only names that are referred to remain, and these go to the
    references, which are not shuffled for it unless the names are more than BROADCAST.
    """
    named = _named(records).select("repo", F.explode(_names()).alias("name"), "fq", F.struct("file_path", "symbol_name").alias("at"))
    index = named.groupBy("repo", "name", "fq").agg(F.min("at").alias("at")).groupBy("repo", "name")
    index = index.agg(F.count("*").alias("n"), F.min(F.struct("fq", "at")).alias("low"), F.max(F.struct("fq", "at")).alias("high"))
    end = lambda name: F.when(F.col("n") <= 2, F.col(name)).alias(name)
    uses = references(records).groupBy("repo", "name").agg(F.count("*").alias("uses"))
    known = checkpointed(index.select("repo", "name", "n", end("low"), end("high")).join(uses, ["repo", "name"]))
    size = known.agg(F.count("*").alias("names"), F.sum(F.when(F.col("n") <= 2, F.col("uses"))).alias("unique"), F.sum(F.when(F.col("n") > 1, F.col("uses"))).alias("ambiguous")).first()
    joined = references(records).join(F.broadcast(known) if size["names"] <= BROADCAST else known, ["repo", "name"])
    own = (F.col("name") == F.col("symbol_name")) | (F.col("name") == F.substring_index("symbol_name", ".", -1))
    others = F.col("n") - own.cast("int")
    target = F.when(others == 1, F.when(own & (F.col("low.fq") == F.col("fq")), F.col("high")).otherwise(F.col("low")))
    rows = joined.select("repo", "fq", "file_path", "symbol_name", "relationship", "name", others.alias("candidates"), target.alias("target"))
    return Resolved(rows, size["unique"] or 0, size["ambiguous"] or 0)


def _once(df: DataFrame, symbol: str, other: str, count: int) -> DataFrame:
    """df with one row for each repo, symbol, relationship and other. Rows are dealt before they are compared, TASK a task: those of a symbol
    go side by side to few tasks, which compresses well, and no task holds more than it has memory for. A record's own are distinct already."""
    dealt = df.withColumn("part", F.pmod(F.xxhash64(other), F.lit(16))).repartition(count // TASK + 1, "repo", symbol, "part")
    return dealt.dropDuplicates(["repo", symbol, "part", "relationship", other]).select(df.columns)


def resolve_edges(records: DataFrame) -> DataFrame:
    """Edges from chunk records (repo, file_path, symbol_name, imports, calls, extends_symbols, implements_symbols): every
    reference that exactly one other symbol of the repository can be, once for each relationship."""
    found = resolved_references(records)
    edges = found.rows.filter("target is not null").select(
        "repo", F.col("fq").alias("from_symbol"), F.col("target.fq").alias("to_symbol"), "relationship", F.col("file_path").alias("from_path"), F.col("symbol_name").alias("from_name"),
        F.col("target.at.file_path").alias("to_path"), F.col("target.at.symbol_name").alias("to_name"),
    )
    return _once(edges, "from_symbol", "to_symbol", found.unique)


def ambiguous_references(records: DataFrame) -> DataFrame:
    """(repo, fq, relationship, name, candidates) of references that several symbols could be."""
    found = resolved_references(records)
    return _once(found.rows.filter("candidates > 1").select("repo", "fq", "relationship", "name", "candidates"), "fq", "name", found.ambiguous)


def symbol_context(edges: DataFrame, chunks: DataFrame, repo: str, symbol: str, exact: bool = False) -> DataFrame:
    """One row for each neighbour: bucket, matched, symbol, file_path, symbol_name, display_content, url.

    By default an end matches if its full name ends with ":symbol" and parts are cut at the last colon;
    exact compares and returns the stored names (edges must have them), which may hold colons.
    Of chunks that share file and name the last by line gives the snippet.
    """
    own = edges.filter(F.col("repo") == repo)
    side = {}
    for end in ("from", "to"):
        fq = F.col(f"{end}_symbol")
        side[end] = (F.col(f"{end}_name") == symbol, F.col(f"{end}_path"), F.col(f"{end}_name")) if exact else (fq.endswith(f":{symbol}"), fq_path(fq), fq_name(fq))
    rows = []
    for here, there, place in (("from", "to", 0), ("to", "from", 1)):
        bucket = F.create_map(*(F.lit(x) for rel, names in BUCKETS.items() for x in (rel, names[place])))[F.col("relationship")]
        match, _, _ = side[here]
        _, path, name = side[there]
        rows.append(own.filter(match).select(bucket.alias("bucket"), F.col(f"{here}_symbol").alias("matched"), F.col(f"{there}_symbol").alias("symbol"), path.alias("file_path"), name.alias("symbol_name")))
    near = rows[0].unionByName(rows[1])
    held = chunks.filter((F.col("repo") == repo) & F.col("symbol_name").isNotNull()).groupBy(F.coalesce("file_path", F.lit("")).alias("file_path"), "symbol_name")
    last = held.agg(F.max_by(F.struct("display_content", "url"), F.struct("start_line", "chunk_id")).alias("c"))
    joined = near.join(last, ["file_path", "symbol_name"], "left")
    return joined.select("bucket", "matched", "symbol", "file_path", "symbol_name", snippet(F.col("c.display_content")).alias("display_content"), F.col("c.url").alias("url"))
