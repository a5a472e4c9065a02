"""Reading tables, and cutting lineage in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from mediacat.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame) -> DataFrame:
    """Rows kept in the shared folder, so that a lost executor does not repeat the work before them."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


def written(rows: DataFrame, **options: int) -> DataFrame:
    """Rows kept as a compressed table in the shared folder, for those too large to store as they are; ``options`` are of the writer."""
    path = f"{shared_folder(rows.sparkSession)}/rows-{uuid.uuid4().hex}"
    rows.write.options(compression="zstd", **options).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
