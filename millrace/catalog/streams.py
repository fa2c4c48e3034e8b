"""Micro-batch ingest run to its end over the event table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.registry import query
from millrace.session import ensure_checkpoint_dir
from millrace.sources.streams import read_stream
from millrace.sources.tables import Tables
from millrace.streaming.ingest import ingest_batch, run_stream

EVENT = "event_id BIGINT, user_id BIGINT, event_type STRING"


@query("SELECT event_id, user_id, event_type FROM events WHERE event_id % 7 <> 0")
def stream_ingest(t: Tables) -> DataFrame:
    """Events as JSON text, every seventh one broken; the good ones arrive."""
    # A streaming file source takes a folder or a pattern, not a single file.
    scratch = f"{ensure_checkpoint_dir(t.spark)}/stream-{uuid.uuid4()}"
    source = read_stream(t.spark, "parquet", f"{t.folder}/event[s].parquet", t.events.schema)
    text = F.to_json(F.struct("event_id", "user_id", "event_type"))
    broken = F.when(F.col("event_id") % 7 == 0, F.substr(text, F.lit(2))).otherwise(text)
    handler = ingest_batch(EVENT, lambda good: good, f"{scratch}/good", f"{scratch}/corrupt")
    run_stream(source.select(broken.alias("value")), handler, f"{scratch}/offsets", every=None).awaitTermination()
    return t.spark.read.orc(f"{scratch}/good").drop("batch_id")
