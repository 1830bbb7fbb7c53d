"""Session settings and shared scratch locations."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Runtime settings the jobs rely on. All can be changed on a running session.
RUNTIME_CONF = {
    # no time zone exists in the source systems; text is parsed field by field
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot join keys: split the oversized partition, even if that costs another
    # exchange above the join
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM does not compile methods above this size: converting a wide table
    # in one generated method would be interpreted, in several it is compiled
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Parquet is decoded into vectors of so many rows: with whole texts in them, the default of
    # 4096 makes arrays of tens of MB that a collector cannot move and enlarges the heap for
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    # rows go to Python and back in batches of this size, however long their texts are
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "quayside", cores: str = "*", shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in spark.checkpoint.dir.

    Only a session on a local master may leave it out and gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.match(r"local(\[[^,]*\])?$", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="quayside-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing folder under the shared root."""
    return f"{shared_root(spark)}/quayside/{name}-{uuid.uuid4().hex}"


def sent_with_jobs(module: str) -> None:
    """Functions of `module` travel inside the task, so executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
