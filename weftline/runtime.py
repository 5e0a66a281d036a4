"""Session, table and lineage helpers shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dirs: dict[str, str] = {}


def build_session(app: str = "weftline", cpus: str | int = "*", **conf: str) -> SparkSession:
    """A local session with the settings the plans assume; a cluster brings its own."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, or an own one where that is unset."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        path = tempfile.mkdtemp(prefix="weftline-")
        atexit.register(shutil.rmtree, path, True)
        spark.sparkContext.setCheckpointDir(f"file://{path}")
        _own_dirs[app] = f"file://{path}"
    return _own_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/weftline/{label}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, label: str = "table") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and a lost executor costs nothing."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """df on all cores before a costly Python stage, where its scan has fewer partitions than there are cores; large scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
