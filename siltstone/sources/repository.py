"""spark.read.format("siltstone_repository"): a target's files as raw documents.

The driver lists paths; each partition fetches a group of them. Options: target, ref, token, email,
base, groups (partitions, 2 by default, as providers limit how much is asked at once). A file that fails to
fetch is a row with a fetch_error, one that the provider has no content for a row without either; a sync counts
the one as failed and the other as skipped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from siltstone.functions.paths import blob_url, content_hash, is_ingestible, language_for
from siltstone.schema import RAW_DOCUMENT, conform
from siltstone.sources import connectors
from siltstone.sources.targets import parse_target


#: What the source gives: raw documents, and why one could not be fetched.
FETCHED = T.StructType([*RAW_DOCUMENT, T.StructField("fetch_error", T.StringType())])


class Paths(InputPartition):
    def __init__(self, paths: list[str], pages: dict[str, tuple[str, str | None]], ref: str | None):
        self.paths, self.pages, self.ref = paths, pages, ref


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def _connector(self, ref: str | None = None) -> connectors.Connector:
        o = self.options
        return connectors.connect(parse_target(o["target"], ref or o.get("ref")), token=o.get("token"), email=o.get("email"), base=o.get("base"))

    def partitions(self) -> list[InputPartition]:
        c = self._connector()
        paths, pages = c.list(), getattr(c, "pages", {})
        n = max(1, min(int(self.options.get("groups", 2)), len(paths)))
        return [Paths(paths[i::n], pages, None if pages else c.ref) for i in range(n)]

    def read(self, partition: Paths) -> Iterator[tuple]:
        c = self._connector(partition.ref)
        if partition.pages:
            c.pages = partition.pages
        for path in partition.paths:
            try:
                row = c.fetch(path)
                error = None
            except Exception as e:  # one file must not end the job
                connectors.log.warning("%s: %s", path, e)
                row, error = None, f"{type(e).__name__}: {e}"[:500]
            if row is None:
                row = {"source_id": f"{c.provider}:{c.target.name}:{path}", "repo": c.target.name, "provider": c.provider, "source_type": "confluence" if c.provider == "confluence" else "code", "file_path": path}
            when = row.get("last_modified")
            row["last_modified"] = datetime.fromisoformat(when.replace("Z", "+00:00")) if when else None
            row["fetch_error"] = error
            yield tuple(row.get(f.name, [] if f.name == "labels" else None) for f in FETCHED)


class Repository(DataSource):
    @classmethod
    def name(cls) -> str:
        return "siltstone_repository"

    def schema(self):
        return FETCHED

    def reader(self, schema) -> DataSourceReader:
        return Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Repository)


def read_checkout(spark: SparkSession, path: str, repo: str, provider: str = "github", ref: str = "main") -> DataFrame:
    """Raw documents from a checked-out tree on any file system Spark reads: files that are taken, by their path below `path`."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    root = re.escape(urlparse(path).path.rstrip("/"))
    named = files.withColumn("file_path", F.regexp_replace("path", f"^.*?{root}/+", "")).filter(is_ingestible(F.col("file_path")))
    text = F.expr("try_validate_utf8(CAST(content AS STRING))")
    docs = named.withColumn("content", F.coalesce(text, F.decode("content", "ISO-8859-1")))
    lit = F.lit
    return conform(
        docs.withColumns(
            {
                "source_type": lit("code"), "repo": lit(repo), "provider": lit(provider), "ref": lit(ref), "language": language_for(F.col("file_path")), "content_hash": content_hash(F.col("content")),
                "source_id": F.concat_ws(":", lit(provider), lit(repo), "file_path"), "url": blob_url(lit(provider), lit(repo), lit(ref), F.col("file_path")),
            }
        ),
        RAW_DOCUMENT,
    )
