"""Spark session defaults and the shared checkpoint folder.

On a cluster the session is created by the platform; ``get_spark`` only
fills settings that are still unset, so cluster-level choices win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied when a session is created by us (tests, bench).  AQE
# coalesces small shuffles and splits skewed join partitions at run time.
LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # remove reliable checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Starting points for a large cluster (100 TB of input, ~1000 executors);
# applied by the platform, not by ``get_spark``.  AQE coalesces the many
# shuffle partitions down to the advisory size and splits skewed ones.
CLUSTER_HINTS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.dir": "<shared storage path>",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "panelkit") -> SparkSession:
    """Return the active session or build a local one with our defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("PANELKIT_DRIVER_MEM", "8g"))
    if os.environ.get("PANELKIT_JIT_HUGE", "1") == "1":
        # let the JIT compile large generated methods (wide projections)
        builder = builder.config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the setting is absent (local tests) is a scratch folder created
    and registered; on a cluster the platform must provide a shared path.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="panelkit-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def stored(df, name: str = "stored"):
    """``df`` as a Parquet table in the shared folder, read back: survives the loss of any executor and
    keeps its columns prunable, which a checkpoint of rows does not.  The folder goes with the driver."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    df.write.parquet(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df):
    """Reliable checkpoint (survives executor loss); never localCheckpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
