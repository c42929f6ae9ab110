"""Session helpers for tests, the bench and local runs.

Library functions never create a session; they take DataFrames. On a
cluster the session (and its ``spark.checkpoint.dir``) comes from the
deployment; ``local_session`` only fills in what is unset.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cores * 2
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("netloom")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # a single machine sees small partitions: split a hot one well below
        # the cluster default of 256 MB (a cluster keeps its own settings)
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "32m")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, a laptop) without the setting gets a
    scratch folder; on a cluster a machine-local folder would not survive
    the loss of an executor, so the setting is required there."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) for this cluster")
        path = tempfile.mkdtemp(prefix="netloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no context; the server checkpoints
        return path
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a
    local checkpoint, which dies with its executor)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for written intermediates, under the shared
    checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/netloom-tables/{spark.conf.get('spark.app.id', 'app')}"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, compact: bool = False) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: later plans scan the written table (with column pruning and size
    statistics) instead of recomputing its lineage.

    With ``partition_by`` (a low-cardinality column such as a scenario id)
    a filter on it reads only the matching folders. The table is read back
    with its own schema, so partition values keep their type. ``compact`` packs
    more tightly, for tables that are many times the input; not for the small side
    of a join, as Spark judges by a file's size what it can broadcast."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path, compression="zstd" if compact else None)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def materialize_by(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """``materialize`` as a table bucketed by ``column``: windows and groupings
    by that column and others move no row."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{scratch_root(spark)}/{table}"
    df.write.bucketBy(buckets, column).option("path", path).option("compression", "zstd").saveAsTable(table)
    return spark.table(table)


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's written intermediates. Call it once the
    results of the queries that wrote them have been consumed."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: remove the folder with the storage's own tools
        return
    path = sc._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)
