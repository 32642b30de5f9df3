"""The two questions a client asks, answered as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.embed import QUERY, Embedder
from siltstone.operators.graph import symbol_context
from siltstone.operators.search import LIMIT, search
from siltstone.schema import SOURCE_TYPES

#: Fixed values, as are the texts below that clients read: sections of a neighbourhood, in the order in which they are shown.
SECTIONS = {"calls": "Calls", "calledBy": "Called by", "extends": "Extends", "extendedBy": "Extended by", "implements": "Implements", "implementedBy": "Implemented by", "imports": "Imports", "importedBy": "Imported by"}
MOST = 20


def fenced(text: Column) -> Column:
    return F.concat(F.lit("\n```\n"), text, F.lit("\n```"))


def result_text() -> Column:
    """One search result: place, score, where it is, link, content."""
    path = F.coalesce("file_path", F.lit("undefined"))
    where = F.when(F.col("symbol_name").isNotNull() & (F.col("symbol_name") != ""), F.concat(path, F.lit(" :: "), "symbol_name", F.lit(" ("), "symbol_type", F.lit(")"))).otherwise(F.concat(path, F.lit(" (whole file)")))
    link = F.when(F.coalesce("url", F.lit("")) != "", F.concat(F.lit("\n"), "url")).otherwise("")
    return F.concat(F.col("place").cast("string"), F.lit(". [score "), F.format_string("%.4f", "score"), F.lit("] "), where, link, fenced(F.col("display_content")))


def entry_text() -> Column:
    link = F.when(F.coalesce("url", F.lit("")) != "", F.concat(F.lit("\n"), "url")).otherwise("")
    shown = F.when(F.coalesce("display_content", F.lit("")) != "", fenced(F.col("display_content"))).otherwise("")
    return F.concat(F.lit("- "), "file_path", F.lit(" :: "), "symbol_name", link, shown)


def search_code(chunks: DataFrame, embedder: Embedder, query: str, repo: str | None = None, limit: int | None = None, source_type: str | None = None) -> str:
    """Results of hybrid search as text; at most MOST of them."""
    try:
        if limit is not None and not 1 <= limit <= MOST:
            raise ValueError(f"limit must be from 1 to {MOST}")
        if source_type and source_type not in SOURCE_TYPES:
            raise ValueError(f"source_type must be one of {', '.join(SOURCE_TYPES)}")
        vector = embedder([query], QUERY)[0]
        rows = search(chunks, query, vector, limit or LIMIT, repo, source_type).select("place", result_text().alias("text")).collect()
    except Exception as e:
        return f"search_code failed: {e}"
    return "\n\n".join(r["text"] for r in sorted(rows, key=lambda r: r["place"])) or "No matching code found."


def get_symbol_context(edges: DataFrame, chunks: DataFrame, symbol: str, repo: str, exact: bool = False) -> str:
    """One symbol's neighbourhood as text."""
    try:
        rows = symbol_context(edges, chunks, repo, symbol, exact).select("bucket", "matched", "symbol", entry_text().alias("text")).collect()
    except Exception as e:
        return f"get_symbol_context failed: {e}"
    if not rows:
        return f'No symbol matching "{symbol}" found in the symbol graph for {repo}.'
    rows.sort(key=lambda r: (r["symbol"], r["matched"]))
    parts = [f"{label}:\n" + "\n".join(found) for key, label in SECTIONS.items() if (found := [r["text"] for r in rows if r["bucket"] == key])]
    matched = ", ".join(sorted({r["matched"] for r in rows}))
    return "\n\n".join([f'Symbol graph for "{symbol}" in {repo} (matched: {matched})', *parts])
