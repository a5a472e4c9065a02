"""Session settings and the shared folder for cut lineage and stream state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are planned for; a cluster's own values win where it sets them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Grouping by (key, part) must not settle for rows that are placed by key alone.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.session.timeZone": "UTC",
    # Stream state (queue keys, saved pairs) grows with the data: keep it off the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build(master: str, partitions: int, name: str = "mediacat", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(name)
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    quiet = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    for key, value in {**DEFAULTS, **quiet, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def kept(rows: DataFrame, name: str) -> DataFrame:
    """Rows kept as a compressed table in the shared folder, to be read more than once; a checkpoint has them as they are."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="mediacat-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")
