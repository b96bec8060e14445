"""Session builder and the shared scratch folder that jobs may write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job wants; none of them depends on cluster size.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Above 8000 bytecodes the JVM does not compile a method; wide projections are then
    # faster as separate operators than as one fused, interpreted loop.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Window and dedup state lives on local disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "clickweir", master: str | None = None,
                  **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors can reach: the session's checkpoint folder.

    A machine-local folder is used only in local mode, where every executor is
    this machine; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None and not sc.master.startswith("local"):
        root = sc.getCheckpointDir()
        if root is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if root is None:
        root = sc.getCheckpointDir() or tempfile.mkdtemp(prefix="clickweir-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the scratch root, never used before."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/clickweir/{app}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str = "stored") -> DataFrame:
    """Write the rows to the scratch folder and read them back.

    Cuts lineage in storage that survives lost executors. As a Parquet table it is
    pruned by column when reread, and its size is known to the planner.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.delete(hadoop_path, True)


def list_path(spark: SparkSession, path: str) -> list[str]:
    """Paths of what lies in a folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [str(f.getPath().toString()) for f in fs.listStatus(hadoop_path)]


def move_path(spark: SparkSession, path: str, target: str) -> None:
    """Rename within a file system; the folder above the target is made."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    source, to = hadoop_path(path), hadoop_path(target)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(to.getParent())
    if not fs.rename(source, to):
        raise OSError(f"cannot move {path} to {target}")
