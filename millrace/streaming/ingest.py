"""Micro-batch ingest: parse, quarantine, enrich, append."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.sinks.folders import BATCH, COMMITTED, STAGED, Folder, compact, recover
from millrace.sources.files import CORRUPT, parse_json, quarantine


def run_stream(source: DataFrame, handle_batch: Callable[[DataFrame, int], None], checkpoint: str,
               every: str | None = "2 seconds", name: str | None = None) -> StreamingQuery:
    """Start ``handle_batch`` on every micro-batch.

    ``every=None`` processes what is there and stops. Offsets live in the
    checkpoint, so a restart continues where the last finished batch ended.
    """
    writer = source.writeStream.foreachBatch(handle_batch).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def write_batch(df: DataFrame, batch_id: int, path: str, fmt: str = "orc") -> None:
    """Write one batch to a folder of its own.

    A batch that is run again after a failure overwrites its folder, so replays
    leave no duplicates. Readers see ``batch_id`` as a partition column.
    ``sinks.folders.compact`` joins many such folders.
    """
    df.write.mode("overwrite").format(fmt).save(f"{path}/{BATCH}={batch_id}")


def ingest_batch(
    schema: str | T.StructType,
    transform: Callable[[DataFrame], DataFrame],
    good_path: str,
    corrupt_path: str,
    column: str = "value",
    fmt: str = "orc",
    compact_every: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """Handler that parses JSON text, sets corrupt text aside and appends the rest.

    The parsed batch is written to a staging folder that readers do not see, and
    both outputs are made from there: each text is parsed once, and a lost
    executor costs a re-read of files. A batch that comes again replaces what it
    had written. ``_committed`` in the good folder names the last batch of which
    both outputs are whole. With ``compact_every`` the folders of good and of
    corrupt batches are compacted each so many batches.
    """

    def handle(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        folder = Folder(spark, good_path)
        mark, staged = f"{COMMITTED}/{BATCH}={batch_id}", f"{STAGED}/{BATCH}={batch_id}"
        for path in (good_path, corrupt_path):
            recover(spark, path)
        parsed = parse_json(df.select(column), column, schema)
        parsed.write.mode("overwrite").parquet(f"{folder.path}/{staged}")
        good, bad = quarantine(spark.read.schema(parsed.schema).parquet(f"{folder.path}/{staged}"))
        write_batch(bad.selectExpr(f"{CORRUPT} AS value"), batch_id, corrupt_path, "text")
        write_batch(transform(good.select("message.*")), batch_id, good_path, fmt)
        folder.mark(mark)
        folder.delete(staged)
        for old in folder.names(COMMITTED):
            if old != f"{BATCH}={batch_id}":
                folder.delete(f"{COMMITTED}/{old}")
        if compact_every and batch_id % compact_every == 0:
            compact(spark, good_path, fmt)
            compact(spark, corrupt_path, "text")

    return handle
