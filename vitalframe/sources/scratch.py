"""Where intermediate tables go: a folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local folder only in local mode without one."""
    shared = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="vitalframe-")
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to scratch and read it back: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
