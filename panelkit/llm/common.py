"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import checkpoint_dir

#: A word, for Java's and Python's regular expressions alike.  ``bytes.split()`` cuts
#: UTF-8 text at exactly these white-space bytes.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def n_words(text) -> F.Column:
    """Number of words of a text column; NULL counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8_crc32(text) -> F.Column:
    """Unsigned CRC32 of the UTF-8 bytes; NULL counts as empty."""
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: cuts the lineage, keeps
    columns prunable and survives the loss of any executor.  The folder goes with the driver."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    df.write.option("compression", "zstd").parquet(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


#: What a Python worker process keeps between its tasks: one object and its key.
KEPT: dict[tuple, object] = {}


def kept(key: tuple, make):
    """``make()``, or what it gave this worker process for the same key before.  Only the newest
    object stays, so what one stage has gathered does not weigh on the next."""
    if key not in KEPT:
        KEPT.clear()
        KEPT[key] = make()
    return KEPT[key]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
