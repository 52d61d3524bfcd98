"""Session helpers for tests, the bench and the jobs' command line.

On a cluster the session comes from the launcher; library code never builds one. Settings here
are the ones the jobs rely on: AQE for partition coalescing and skew, UTC session time, the
Spark UI off, and a checkpoint directory taken from the cluster when it names one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Fall back from whole-stage code generation when a generated method is too large for the
    # JVM to JIT-compile (8000 bytes of bytecode); the sentiment stage otherwise runs as
    # interpreted bytecode.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Keep little per-execution history in the driver: the plans here are large, and a long
    # session (tests, the bench) would otherwise spend its time in garbage collection.
    "spark.sql.ui.retainedExecutions": "20",
    "spark.ui.retainedJobs": "50",
    "spark.ui.retainedStages": "50",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "lexitrend",
                  memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench (one JVM, ``cores`` task threads)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
    )
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting a scratch one only when the session has none.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that setting always wins, and a
    cluster session without it is an error (a machine-local folder would not be shared).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        # One process holds driver and executors (tests, the bench): a scratch folder is shared.
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lexitrend-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return sc.getCheckpointDir()


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet (with the writer's ``options``) below the checkpoint directory and read
    back: like a checkpoint, but compressed and by columns, so a reader of few columns or rows skips the
    rest. Deleted with the JVM."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    df.write.options(**options).parquet(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Have the driver's JVM collect its garbage, upon which Spark deletes the shuffle files of jobs that
    are done; else they lie on disk until the JVM happens to collect."""
    spark.sparkContext._jvm.System.gc()
