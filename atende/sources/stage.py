"""The shared work folder and intermediate results kept in it."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_local_roots: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Shared folder for stored tables: ``spark.checkpoint.dir``, never a node-local one.

    A temporary folder is made only where the setting is missing and the master is local.
    """
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None) or _local_roots.get(app)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_roots[app] = tempfile.mkdtemp(prefix="atende-")
    return os.path.join(root, f"atende-{app}")


def staged(df: DataFrame) -> DataFrame:
    """Write an intermediate result as a table in the shared folder and read it back.

    Cuts the lineage: what is used several times is computed once, the planner knows its
    size, and a lost executor costs a re-read instead of the upstream plan.
    """
    path = os.path.join(work_dir(df.sparkSession), "stage", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
