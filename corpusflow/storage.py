"""Where intermediate data may live.

Executors can be lost, so anything cut from its lineage goes to the shared folder the
cluster names in ``spark.checkpoint.dir``. A local run without that setting gets a
temporary folder; a cluster without it is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="corpusflow-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def staging_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise a DataFrame reliably, so values computed once stay as they are."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
