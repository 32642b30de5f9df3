"""Source files: one chunk a symbol. Python finds the symbols; Spark builds the chunks."""

from __future__ import annotations

import gc
from bisect import bisect_right
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.paths import chunk_id, joined_parts, with_lines
from siltstone.operators.code import java, python, typescript
from siltstone.operators.code.model import SourceFile
from siltstone.operators.doc_chunks import chunk_pages
from siltstone.runtime import modest
from siltstone.schema import CHUNK, conform

#: Scanners by language; add one to chunk another language.
SCANNERS: dict[str, Callable[[str], SourceFile]] = {"python": python.scan, "java": java.scan, "typescript": typescript.scan, "javascript": typescript.scan}

LISTS = ("calls", "markers", "extends", "implements")
TEXTS = ("comment", "notes", "signature", "route")
_strings = pa.list_(pa.string())
SYMBOL = pa.struct(
    [
        ("name", pa.string()), ("kind", pa.string()), ("body", pa.string()), ("start_line", pa.int32()), ("end_line", pa.int32()), ("exported", pa.bool_()),
        *((k, _strings) for k in LISTS), *((k, pa.string()) for k in TEXTS),
    ]
)
FOUND = pa.struct([("imports", _strings), ("header", pa.string()), ("package", pa.string()), ("error", pa.string()), ("symbols", pa.list_(SYMBOL))])
FOUND_SQL = (
    "struct<imports: array<string>, header: string, package: string, error: string, symbols: array<struct<name: string, kind: string, body: string, start_line: int, end_line: int, "
    "exported: boolean, calls: array<string>, markers: array<string>, extends: array<string>, implements: array<string>, comment: string, notes: string, signature: string, route: string>>>"
)


@contextmanager
def uncollected() -> Iterator[None]:
    """Without searches for cycles: syntax trees have none, and they are large."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def scanned(content: str | None, language: str | None, path: str | None) -> tuple[SourceFile, str | None]:
    """What one file holds, and a message where its scanner failed: then it has no symbol and becomes one chunk."""
    scan = SCANNERS.get(language or "")
    if content is None or scan is None:
        return SourceFile(), None
    try:
        with uncollected():
            return (typescript.scan(content, not (path or "").endswith(".ts")) if scan is typescript.scan else scan(content)), None
    except Exception as e:  # one file must not end the job
        return SourceFile(), f"{type(e).__name__}: {e}"[:500]


def line_starts(content: str) -> list[int]:
    out, at = [0], content.find("\n")
    while at >= 0:
        out.append(at + 1)
        at = content.find("\n", at + 1)
    return out


def _lists(rows: list[list[str]]) -> pa.ListArray:
    return pa.array(rows, _strings)


def found_array(contents: list[str | None], languages: list[str | None], paths: list[str | None]) -> pa.StructArray:
    """FOUND of each file, its columns built one by one. A file without symbols has one that is nameless and holds it whole, null content has none."""
    imports, headers, packages, errors, ends = [], [], [], [], [0]
    columns: dict[str, list] = {f.name: [] for f in SYMBOL}
    for content, language, path in zip(contents, languages, paths, strict=True):
        found, error = scanned(content, language, path)
        imports.append(found.imports)
        headers.append(found.header)
        packages.append(found.package)
        errors.append(error)
        missing, content = content is None, content or ""
        starts = line_starts(content)
        for s in found.symbols:
            columns["name"].append(s.name)
            columns["kind"].append(s.kind)
            columns["body"].append(" " * s.indent + content[s.start : s.end])
            columns["start_line"].append(bisect_right(starts, s.start))
            columns["end_line"].append(bisect_right(starts, s.end))
            columns["exported"].append(s.exported)
            for k in (*LISTS, *TEXTS):
                columns[k].append(getattr(s, k))
        if not found.symbols and not missing:
            for k, value in {"body": content, "start_line": 1, "end_line": len(starts), "exported": False}.items():
                columns[k].append(value)
            for k in columns.keys() - {"body", "start_line", "end_line", "exported"}:
                columns[k].append([] if k in LISTS else "other" if k == "kind" else None)
        ends.append(len(columns["body"]))
    symbols = pa.StructArray.from_arrays([pa.array(columns[f.name], f.type) for f in SYMBOL], fields=list(SYMBOL))
    nested = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), symbols)
    return pa.StructArray.from_arrays([_lists(imports), pa.array(headers, pa.string()), pa.array(packages, pa.string()), pa.array(errors, pa.string()), nested], fields=list(FOUND))


def find_symbols(content: str, language: str, path: str) -> Column:
    """FOUND of each file as a column. Spark takes it as not deterministic, else it would copy it, and what makes the content, into filters that it infers, and
    scan each file once for each."""

    @F.arrow_udf(FOUND_SQL)
    def found(content: pa.Array, language: pa.Array, path: pa.Array) -> pa.Array:
        return found_array(content.to_pylist(), language.to_pylist(), path.to_pylist())

    return found.asNondeterministic()(content, language, path)


def chunk_code(docs: DataFrame) -> DataFrame:
    """Chunks of source files (source_id, content, repo, file_path, language, url, last_modified, content_hash), with an
    error column for files that could not be scanned. A file without symbols is one chunk named after no symbol.
    Nothing but symbols goes through the explode; a file's whole text is never copied beside each of them."""
    for name, kind in (("repo", "string"), ("url", "string"), ("last_modified", "timestamp"), ("content_hash", "string")):
        if name not in docs.columns:
            docs = docs.withColumn(name, F.lit(None).cast(kind))
    modest(docs.sparkSession)
    about = ("source_id", "repo", "file_path", "language", "url", "last_modified", "content_hash")
    files = docs.select(*about, find_symbols("content", "language", "file_path").alias("f"))
    f = F.col("f")
    each = files.select(*about, f["imports"].alias("imports"), f["header"].alias("header"), f["package"].alias("package"), f["error"].alias("error"), F.explode(f["symbols"]).alias("s"))
    s = lambda name: F.col("s")[name]
    whole = s("name").isNull()
    labelled = lambda label, value: F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(label), value))
    text = joined_parts(
        labelled("File: ", F.col("file_path")), labelled("Route: ", s("route")), F.when(F.coalesce("package", F.lit("")) != "", F.concat(F.lit("package "), F.col("package"), F.lit(";"))),
        labelled("Imports:\n", F.col("header")), labelled("Class: ", s("signature")), s("notes"), s("comment"), s("body"),
    )
    shown = F.concat(F.when(s("comment") != "", F.concat(s("comment"), F.lit("\n"))).otherwise(""), s("body"))
    or_whole = lambda value, other: F.when(whole, other).otherwise(value)
    name, start, end = F.coalesce(s("name"), F.lit("__file__")), s("start_line"), s("end_line")
    out = each.select(
        "source_id", "repo", "file_path", "language", "last_modified", "content_hash", "error", F.lit("code").alias("source_type"), chunk_id(F.col("source_id"), name, start).alias("chunk_id"),
        or_whole(text, F.concat(F.lit("File: "), F.col("file_path"), F.lit("\n\n"), s("body"))).alias("content"), or_whole(shown, s("body")).alias("display_content"),
        s("name").alias("symbol_name"), s("kind").alias("symbol_type"), start.alias("start_line"), end.alias("end_line"), "imports",
        s("calls").alias("calls"), s("extends").alias("extends_symbols"), s("implements").alias("implements_symbols"), s("exported").alias("exported"),
        s("markers").alias("framework_markers"), or_whole(with_lines(F.col("url"), start, end), F.col("url")).alias("url"),
    )
    return conform(out, CHUNK, extra=("error",))


def chunk_documents(docs: DataFrame) -> DataFrame:
    """Chunks of raw documents by their kind: pages by heading, source files by symbol; other kinds give none."""
    code = chunk_code(docs.filter(F.col("source_type") == "code")).drop("error")
    return code.unionByName(chunk_pages(docs.filter(F.col("source_type") == "confluence")))
