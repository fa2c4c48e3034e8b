"""Readers for tables that already have a schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet table ``name`` of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Tables:
    """Attribute access to the Parquet tables of one folder: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return load(self.spark, self.folder, name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Metastore table."""
    return spark.table(name)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    n: int = 1,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a database read.

    One partition means one connection doing all the work. Give a partition
    column with its bounds to read with ``n`` connections; rows outside the
    bounds are still read, by the first and last partition.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs bounds")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(n),
        )
    elif n > 1:
        raise ValueError("several partitions need a partition column")
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()
