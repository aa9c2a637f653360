"""Written intermediate tables, for iterations that must not carry their lineage along."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def fresh_path(spark: SparkSession) -> str:
    """A path in the shared folder that spark.checkpoint.dir names; a local session, which has one machine, may do without."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="spark-stage-", dir="/tmp"))
        root = _own[0]
    return f"{root.rstrip('/')}/stage-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df, written in the shared folder and read again."""
    path = fresh_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
