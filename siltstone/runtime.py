"""What a session needs so that executors can import this package and workers stay small, and lineage cut in the folder that all machines share."""

from __future__ import annotations

import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)
#: Rows that Spark hands to a Python worker at once, at most: whole texts of long stages in one executor add up.
ARROW_ROWS = 1_000
#: Bytes of such a batch, about, at most: long texts would make it large.
ARROW_BYTES = 2 << 20


def importable(spark: SparkSession) -> SparkSession:
    """Adds this repository to the path of Python workers started from now on. On clusters whose
    executors have it elsewhere, ship the package with --py-files."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join(filter(None, [*paths, ROOT]))
    return spark


def modest(spark: SparkSession) -> None:
    """Sets the session's Arrow batches to ARROW_ROWS rows and ARROW_BYTES bytes, unless the rows are fewer: memory in the JVM and in
    Python workers follows them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def checkpointed(df: DataFrame) -> DataFrame:
    """df computed once and kept under spark.checkpoint.dir. A local session without one gets a folder of its own; elsewhere
    that is an error."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        found = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not found and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(found or tempfile.mkdtemp(prefix="siltstone-"))
    return df.checkpoint()
