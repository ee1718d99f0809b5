"""Session construction and shared-folder helpers.

On a cluster the session is built by the platform; we only read its settings. The
checkpoint directory must be a shared folder (``spark.checkpoint.dir``); a local one is
created only for ``local[...]`` masters, as in tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Defaults for a laptop / CI session. On a cluster size shuffle partitions to the data
# (about 128-256 MB per partition) and let AQE coalesce; see README "Scale".
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = "local[*]", app: str = "rankfold",
                shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a local one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="rankfold-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back, so what is derived from it twice
    is computed once and survives a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, name: str, **aggregates: Column) -> tuple[DataFrame, dict]:
    """``written``, with aggregates over the written rows from the same job. They are observed at
    its last stage, whose tasks count once however often they run."""
    spark = df.sparkSession
    path, seen = scratch_path(spark, name), Observation(name)
    df.observe(seen, *[c.alias(k) for k, c in aggregates.items()]).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written intermediate tables."""
    return f"{checkpoint_dir(spark)}/scratch/{name}-{uuid.uuid4().hex}"
