"""Reading stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, row_id: str) -> DataFrame:
    """Use every core on a table of fewer files than cores; a table of many files is left as it is."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted, row_id)
