"""Incremental sync of a stream of raw documents, one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.operators.embed import Embedder
from siltstone.operators.store import Snapshots, free_name
from siltstone.plans.ingest import run


def newest(batch: DataFrame) -> DataFrame:
    """One row a source: the last by last_modified, then by hash."""
    nth = free_name(batch, "nth")
    order = W.partitionBy("source_id").orderBy(F.desc_nulls_last("last_modified"), "content_hash")
    return batch.withColumn(nth, F.row_number().over(order)).filter(F.col(nth) == 1).drop(nth)


def start(documents: DataFrame, table: Snapshots, edges_path: str, embedder: Embedder, checkpoint: str, once: bool = False):
    """Starts the query. The only state is the table itself, so a batch that runs twice changes nothing the second time."""

    def each(batch: DataFrame, _: int) -> None:
        run(newest(batch), table, edges_path, embedder)

    writer = documents.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
