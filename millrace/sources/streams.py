"""Streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.sources.files import as_struct


def kafka_options(servers: str, topic: str, starting: str = "latest", **extra: str) -> dict[str, str]:
    """Options of a topic read. ``starting`` only matters for the first run: after
    that the checkpoint of the query holds the offsets."""
    if starting not in ("earliest", "latest"):
        raise ValueError("starting is 'earliest' or 'latest'")
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, **extra}


def read_stream(spark: SparkSession, kind: str, path: str | None = None,
                schema: str | T.StructType | None = None, **options: str) -> DataFrame:
    """Stream with a text column ``value``, or with ``schema`` for typed files.

    ``kind="kafka"`` needs the Kafka connector package on the cluster.
    """
    reader = spark.readStream.format(kind).options(**options)
    if kind == "kafka":
        return reader.load().selectExpr("CAST(value AS STRING) AS value")
    if schema is not None:
        reader = reader.schema(as_struct(schema))
    return reader.load(path)
