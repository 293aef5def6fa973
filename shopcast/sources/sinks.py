"""Sinks S08-S10: engineered Parquet, CSV reports, findings tables.

All writes are distributed (each task writes its own part files); nothing
is collected to the driver. Paths should point at shared storage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_engineered(df: DataFrame, path: str, partition_by: str = "Year") -> None:   # S08
    """Engineered frame as Parquet partitioned by year (prunable by Date)."""
    if partition_by not in df.columns:
        df = df.withColumn(partition_by, F.year("Date"))
    df.write.mode("overwrite").partitionBy(partition_by).parquet(path)


#: Buckets of a clustered table.
BUCKETS = 64


def write_clustered(df: DataFrame, path: str, by: str = "Store", order: str = "Date", buckets: int = BUCKETS) -> DataFrame:   # S08
    """Rows hashed into buckets by ``by`` and sorted inside them, and the table
    read back: windows, aggregates and joins on ``by`` then need no exchange,
    since a bucket lies in one task. The table's name ends in a random number;
    it lives in the session's catalogue, its files at ``path``. Buckets bound a
    task's rows only where no single key holds most of them; take more for more
    rows."""
    name = f"clustered_{uuid.uuid4().hex[:12]}"
    # One task per bucket, so that a bucket is one sorted file.
    rows = df.repartition(buckets, by)
    rows.write.option("path", path).format("parquet").bucketBy(buckets, by).sortBy(by, order).saveAsTable(name)
    return df.sparkSession.table(name)


def write_csv(df: DataFrame, path: str) -> None:                                    # S09
    """Report table as CSV with a header (one folder of part files)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_findings(spark: SparkSession, findings, root: str) -> DataFrame:          # S10
    """Every evidence table to ``root/<key>/<table>/`` and one index table
    (key, question, insight, tables) at ``root/_index``."""
    rows = []
    for f in findings:
        for name, t in f.tables.items():
            t.write.mode("overwrite").parquet(f"{root}/{f.key}/{name}")
        rows.append((f.key, f.question, f.insight, sorted(f.tables)))
    index = spark.createDataFrame(rows, "key string, question string, insight string, tables array<string>")
    index.write.mode("overwrite").parquet(f"{root}/_index")
    return index
