"""From raw documents to the next state of the chunk table and the symbol graph."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.code_chunks import chunk_documents
from siltstone.operators.embed import Embedder, embedded
from siltstone.operators.graph import resolve_edges
from siltstone.operators.store import Snapshots, changed_files, latest, merge_chunks, prune_missing_sources, prune_stale, sync_status, write_edges


@dataclass
class Sync:
    stored: DataFrame
    status: DataFrame
    #: Repositories whose chunks may have changed.
    repos: DataFrame


def sync(docs: DataFrame, stored: DataFrame, embedder: Embedder, work: str, now: Column | None = None, streams: int | None = None, prune_missing: bool = False) -> Sync:
    """stored after docs: changed sources are chunked and embedded, what was embedded is upserted, and their other
    chunks go. A source of which no chunk could be embedded loses all and is failed; one of which some could counts
    as done until its content changes. Sources that could not be fetched (fetch_error) or have no content keep what is stored.
    Sources that are no longer listed stay unless prune_missing.

    What the embedding service said is written once under the folder work, so that a lost executor does not ask it again and status and table
    rest on the same answers."""
    spark = docs.sparkSession
    fetched = docs.filter(F.col("fetch_error").isNull()).drop("fetch_error") if "fetch_error" in docs.columns else docs
    changed = changed_files(fetched.filter(F.col("content").isNotNull()), stored)
    at = f"{work.rstrip('/')}/embedded-{uuid.uuid4().hex}"
    embedded(latest(chunk_documents(changed)), embedder, streams=streams).write.parquet(at)
    made = spark.read.parquet(at)
    good = made.filter(F.col("embedding").isNotNull())
    merged = prune_stale(merge_chunks(stored, good, now), changed, good)
    repos = changed.select("repo")
    if prune_missing:
        gone = stored.join(docs.select("source_id"), "source_id", "left_anti").select("repo")
        merged, repos = prune_missing_sources(merged, docs), repos.unionByName(gone)
    return Sync(merged, sync_status(docs, stored, made, good), repos.filter("repo is not null").distinct())


def graph(stored: DataFrame, repo: str | None = None) -> DataFrame:
    """Edges among the code symbols of one repository, or of each."""
    code = stored.filter((F.col("source_type") == "code") & F.col("symbol_name").isNotNull())
    return resolve_edges(code.filter(F.col("repo") == repo) if repo else code)


def run(docs: DataFrame, table: Snapshots, edges_path: str, embedder: Embedder, **options) -> dict[str, int]:
    """sync() into a new snapshot, then the graph of the repositories that changed; how many files were indexed, skipped and failed.
    Intermediate files lie in the table's folder and go at the end."""
    work = f"{table.path}/work-{uuid.uuid4().hex}"
    done = sync(docs, table.read(), embedder, work, **options)
    told = {r["status"]: r["count"] for r in done.status.groupBy("status").count().collect()}
    done.repos.write.parquet(f"{work}/repos")
    table.write(done.stored)
    repos = table.spark.read.parquet(f"{work}/repos")
    write_edges(graph(table.read().join(repos, "repo", "left_semi")), edges_path, repos)
    table.fs.delete(table._path(work), True)
    return {k: told.get(k, 0) for k in ("indexed", "skipped", "failed")}
