"""Session helpers: local session for tests/bench, shared checkpoint folder,
and lineage cuts written to that folder (never localCheckpoint)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster deployment would also want; sizes are conservative and
# meant to be overridden by spark-submit --conf at 100 TB scale.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "shopcast") -> SparkSession:
    """Local session for tests and the bench; on a cluster use the
    session spark-submit created (``SparkSession.getActiveSession()``)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions",
                             str(shuffle_partitions or int(cpus)))
    builder = builder.config("spark.driver.memory", os.environ.get("SHOPCAST_DRIVER_MEM", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (to a shared file system) by the deployer;
    only when it is unset, as in tests on one machine, a scratch folder is
    created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="shopcast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet under the checkpoint folder
    and reading it back. Survives executor loss (unlike cached blocks) and
    lets later stages prune columns and push filters into the scan. The
    folder goes when the application ends."""
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)
