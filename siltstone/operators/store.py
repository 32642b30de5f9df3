"""The chunk table: what changed, upsert, pruning, status, and tables on disk that are replaced as a whole or by part."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.schema import EDGE, STORED_CHUNK, conform

#: What an upsert leaves as it was in a chunk that is there already.
KEPT = ("source_type", "source_id", "repo", "file_path", "language", "url", "created_at")


def free_name(df: DataFrame, name: str) -> str:
    """name, with as many underscores after it as make it a new column of df."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def changed_files(docs: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows of docs (source_id, content_hash, ...) whose source is not stored or has another hash."""
    known = stored.groupBy("source_id").agg(F.min("content_hash").alias("stored_hash"))
    joined = docs.join(known, "source_id", "left")
    return joined.filter(~F.col("content_hash").eqNullSafe(F.col("stored_hash"))).select(docs.columns)


def latest(new: DataFrame, ordinal: Column | None = None) -> DataFrame:
    """One row a chunk_id, the last by ordinal (by default by line)."""
    order = ordinal if ordinal is not None else F.struct("start_line", "end_line", F.sha2("content", 256))
    nth = free_name(new, "nth")
    return new.withColumn(nth, F.row_number().over(W.partitionBy("chunk_id").orderBy(order.desc()))).filter(F.col(nth) == 1).drop(nth)


def merge_chunks(old: DataFrame, new: DataFrame, now: Column | None = None, refresh_url: bool = False) -> DataFrame:
    """old with new upserted by chunk_id: new chunks come in, known ones take the new values but for KEPT; updated_at
    is now for both. refresh_url also takes the new url."""
    now = F.current_timestamp() if now is None else now
    a = conform(old, STORED_CHUNK).alias("a")
    b = conform(latest(new), STORED_CHUNK).alias("b")
    is_new, is_old = F.col("b.chunk_id").isNotNull(), F.col("a.chunk_id").isNotNull()

    def column(name: str) -> Column:
        mine, other = F.col(f"a.{name}"), F.col(f"b.{name}")
        if name == "chunk_id":
            return F.coalesce(mine, other)
        if name == "updated_at":
            return F.when(is_new, now).otherwise(mine)
        if name == "created_at":
            return F.when(is_old, mine).otherwise(now)
        if name in KEPT and not (name == "url" and refresh_url):
            return F.when(is_old, mine).otherwise(other)
        return F.when(is_new, other).otherwise(mine)

    return a.join(b, F.col("a.chunk_id") == F.col("b.chunk_id"), "full").select(*(column(f.name).alias(f.name) for f in STORED_CHUNK))


def prune_stale(stored: DataFrame, touched: DataFrame, keep: DataFrame) -> DataFrame:
    """stored without the chunks of touched sources (source_id) that keep (source_id, chunk_id) lacks."""
    was, stays = free_name(stored, "touched"), free_name(stored, "stays")
    marked = stored.join(touched.select("source_id").distinct().withColumn(was, F.lit(True)), "source_id", "left")
    marked = marked.join(keep.select("source_id", "chunk_id").distinct().withColumn(stays, F.lit(True)), ["source_id", "chunk_id"], "left")
    return marked.filter(F.col(was).isNull() | F.col(stays).isNotNull()).select(stored.columns)


def prune_missing_sources(stored: DataFrame, listed: DataFrame) -> DataFrame:
    """stored without the chunks of sources that are not listed (source_id)."""
    return stored.join(listed.select("source_id").distinct(), "source_id", "left_semi").select(stored.columns)


def sync_status(docs: DataFrame, stored: DataFrame, chunked: DataFrame, embedded: DataFrame) -> DataFrame:
    """(source_id, status, failed_chunks): failed where the source could not be fetched (docs may have a column fetch_error) or no
    chunk of a changed source was embedded, skipped where nothing changed or the provider gave no content (null), else indexed.
    chunked and embedded: (source_id) a row a chunk."""
    error = F.col("fetch_error") if "fetch_error" in docs.columns else F.lit(None).cast("string")
    seen = docs.groupBy("source_id").agg(F.max(error).alias("problem"), F.max(F.col("content").isNull() if "content" in docs.columns else F.lit(False)).alias("empty"))
    new = changed_files(docs, stored).select("source_id").distinct().withColumn("changed", F.lit(True))
    count = lambda df, name: df.groupBy("source_id").agg(F.count("*").alias(name))
    joined = seen.join(new, "source_id", "left").join(count(chunked, "made"), "source_id", "left").join(count(embedded, "kept"), "source_id", "left")
    kept = F.coalesce("kept", F.lit(0))
    failed = F.col("problem").isNotNull()
    idle = F.col("changed").isNull() | F.col("empty")
    status = F.when(failed, "failed").when(idle, "skipped").when(kept == 0, "failed").otherwise("indexed")
    return joined.select("source_id", status.alias("status"), F.when(failed | idle, 0).otherwise(F.coalesce("made", F.lit(0)) - kept).alias("failed_chunks"))


def summary(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count("*").alias("files"))


class Snapshots:
    """A table as numbered Parquet snapshots under one folder, on any file system that Spark writes to. A snapshot counts once its last file, Spark's mark of
    success, is there, and the one of the largest number is the table. Nothing that is there is moved or deleted, so a reader has the old
    snapshot or the new one at any time, and a writer that ends half-way leaves the old one. tidy() drops what is older than the last few."""

    NAME = re.compile(r"snapshot-(\d{12})-[0-9a-f]{32}")

    def __init__(self, spark: SparkSession, path: str, partition_by: tuple[str, ...] = ()):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), partition_by
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def complete(self) -> list[str]:
        """Names of the snapshots that are whole, in order."""
        if not self.fs.exists(self._path(self.path)):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(self._path(self.path))]
        return sorted(n for n in names if self.NAME.fullmatch(n) and self.fs.exists(self._path(f"{self.path}/{n}/_SUCCESS")))

    def current(self) -> str | None:
        names = self.complete()
        return f"{self.path}/{names[-1]}" if names else None

    def read(self, schema=STORED_CHUNK) -> DataFrame:
        at = self.current()
        return self.spark.read.schema(schema).parquet(at) if at else self.spark.createDataFrame([], schema)

    def write(self, df: DataFrame) -> str:
        """df as the next snapshot; df may read the present one."""
        names = self.complete()
        number = int(self.NAME.fullmatch(names[-1])[1]) + 1 if names else 1
        name = f"snapshot-{number:012d}-{uuid.uuid4().hex}"
        writer = df.write.partitionBy(*self.partition_by) if self.partition_by else df.write
        writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{self.path}/{name}")
        return name

    def tidy(self, keep: int = 2) -> None:
        """Drops all but the last `keep` whole snapshots, and unfinished ones older than these. For when no reader holds them."""
        last = self.complete()[-keep:]
        for s in self.fs.listStatus(self._path(self.path)) if last else []:
            name = s.getPath().getName()
            if self.NAME.fullmatch(name) and name < last[0]:
                self.fs.delete(s.getPath(), True)


def edges_of(spark: SparkSession, path: str) -> DataFrame:
    """The edges at path, those of all repositories; none where nothing was written yet."""
    return Snapshots(spark, path, ("repo",)).read(EDGE)


def replaced_edges(old: DataFrame, new: DataFrame, repos: DataFrame) -> DataFrame:
    """old with the edges of the rebuilt repositories (repo) dropped and new ones in their place: a repository that resolves to no
    edge has none afterwards."""
    rebuilt = F.broadcast(repos.select("repo").distinct())  # edges stay where they are
    rest = old.join(rebuilt, "repo", "left_anti").select(*EDGE.names)
    return rest.unionByName(conform(new.join(rebuilt, "repo", "left_semi"), EDGE))


def write_edges(edges: DataFrame, path: str, repos: DataFrame) -> None:
    """Replaces the edges of the rebuilt repositories (repo) by those of df, whether or not df has any for them; others stay. One
    snapshot partitioned by repository, rows of a repository dealt over tasks by their symbol."""
    spark = edges.sparkSession
    table = Snapshots(spark, path, ("repo",))
    every = replaced_edges(table.read(EDGE), edges, repos)
    table.write(every.repartition("repo", F.pmod(F.xxhash64("from_symbol"), F.lit(16))))
