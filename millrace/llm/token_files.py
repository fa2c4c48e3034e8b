"""Token ids as Parquet list columns in the order of the documents, and their selective readers."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.llm.shared import text_or_empty, written
from millrace.llm.token_ids import token_ids

# Bytes of ids that a task hands on at once.
BATCH_BYTES = 4 << 20

FILE_SCHEMA = "part int, doc_id bigint, at bigint, n_tokens int, ids array<int>"


@dataclass(frozen=True)
class Layout:
    """How the files are cut and encoded.

    ``encoding`` of the ids: "dictionary" (bit-packed places in a dictionary of
    the ids that a row group holds) or "delta" (bit-packed differences); the
    columns beside the ids are always delta encoded. ``rows_per_file`` documents
    go to a file on average, row groups end at ``group_bytes``, pages at
    ``page_bytes`` or ``page_rows`` documents, whichever comes first. The
    writer adds the index of pages, by which a reader skips them.
    """

    encoding: str = "dictionary"
    rows_per_file: int = 16_384
    group_bytes: int = 32 << 20
    page_bytes: int = 256 << 10
    page_rows: int = 1_000
    codec: str = "zstd"

    def options(self) -> dict[str, str]:
        if self.encoding not in ("dictionary", "delta"):
            raise ValueError(f"unknown encoding: {self.encoding}")
        return {
            "compression": self.codec,
            "parquet.compression.codec.zstd.level": "1",
            "parquet.writer.version": "v2",
            "parquet.block.size": str(self.group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "parquet.page.row.count.limit": str(self.page_rows),
            "parquet.enable.dictionary": "false",
            "parquet.enable.dictionary#ids.list.element": str(self.encoding == "dictionary").lower(),
        }


def _ranges(ids: DataFrame, rows_per_file: int) -> tuple[np.ndarray, int]:
    """Bounds of ``doc_id`` between the files, and how many files the NULL ids take. Reads that column twice."""
    rows, known = ids.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    files = max(1, -(-known // rows_per_file))
    bounds: list[int] = []
    if files > 1:
        shares = [i / files for i in range(1, files)]
        bounds = ids.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * files))).first()[0]
    return np.array(bounds, dtype=np.int64), -(-(rows - known) // rows_per_file)


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, layout: Layout = Layout()
) -> None:
    """Write the ids of every document and ``end_id`` behind them to Parquet files in ascending ``doc_id`` order.

    ``doc_id`` is an integer. File k holds the documents between two bounds of
    it, sorted, with ``part`` k and ``at``, the number of ids before a document
    in its file. Texts are encoded once and only ids are shuffled, in two bytes
    where the vocabulary allows. Documents that share an id are dealt over all
    files that the bounds give it, so an id with a third of all rows fills files
    like any other; among themselves they are in no particular order. NULL ids
    come last. NULL and empty texts are the end token alone; an empty table
    gives files without rows. Needs two narrow jobs for the bounds.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    bounds, null_files = _ranges(rows.select("doc_id"), layout.rows_per_file)
    files = len(bounds) + 1 + null_files
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = token_ids(tokenizer)
        kind = np.dtype("<u2" if max(to_ids.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        seen = 0
        for b in batches:
            known = b.column(0).is_valid().to_numpy(zero_copy_only=False)
            keys = b.column(0).fill_null(0).to_numpy()
            salt = seen + np.arange(b.num_rows)
            low, high = np.searchsorted(bounds, keys, "left"), np.searchsorted(bounds, keys, "right")
            part = np.where(known, low + salt % (high - low + 1), len(bounds) + 1 + salt % max(1, null_files)).astype(np.int32)
            seen += b.num_rows
            for at, made in _in_batches((np.frombuffer(to_ids(t.as_py()) + end, "<u4").astype(kind).tobytes() for t in b.column(1))):
                n = len(made)
                sizes = np.array([len(x) // kind.itemsize for x in made], dtype=np.int32)
                yield pa.record_batch(
                    [pa.array(part[at : at + n]), b.column(0).slice(at, n), pa.array(sizes), pa.array(made, pa.binary())],
                    names=["part", "doc_id", "n_tokens", "packed"],
                )

    def as_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_part, total = -1, 0
        for b in batches:
            part, sizes = b.column(0).to_numpy(), b.column(2).to_numpy()
            at = np.empty(b.num_rows, dtype=np.int64)
            for cut in np.split(np.arange(b.num_rows), np.flatnonzero(np.diff(part)) + 1):
                if len(cut) and part[cut[0]] != at_part:
                    at_part, total = part[cut[0]], 0
                upto = total + np.cumsum(sizes[cut], dtype=np.int64)
                at[cut] = upto - sizes[cut]
                total = int(upto[-1]) if len(cut) else total
            for first, made in _in_batches(x.as_buffer() for x in b.column(3)):
                n = len(made)
                own = sizes[first : first + n]
                kind = "<u2" if made[0].size == 2 * own[0] else "<u4"
                values = np.frombuffer(b"".join(made), kind).astype(np.int32)
                ends = np.concatenate([[0], np.cumsum(own, dtype=np.int32)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                yield pa.record_batch(
                    [b.column(0).slice(first, n), b.column(1).slice(first, n), pa.array(at[first : first + n]), pa.array(own), lists],
                    names=["part", "doc_id", "at", "n_tokens", "ids"],
                )

    packed = rows.mapInArrow(encode, "part int, doc_id bigint, n_tokens int, packed binary")
    # Equal rows end up side by side in a file whatever task they came from.
    order = [F.col("part"), F.asc_nulls_last("doc_id"), F.col("n_tokens"), F.crc32("packed")]
    dealt = packed.repartitionById(files, F.col("part")).sortWithinPartitions(*order)
    out = dealt.mapInArrow(as_lists, FILE_SCHEMA)
    out.write.options(**layout.options()).parquet(path)


def _in_batches(made: Iterator) -> Iterator[tuple[int, list]]:
    """Consecutive values of about ``BATCH_BYTES`` together, with the place of the first."""
    first, held, size = 0, [], 0
    for x in made:
        held.append(x)
        size += len(x) if isinstance(x, bytes) else x.size
        if size >= BATCH_BYTES:
            yield first, held
            first, held, size = first + len(held), [], 0
    if held:
        yield first, held


def read_tokens(
    spark: SparkSession, path: str, columns: tuple[str, ...] = ("doc_id", "start", "n_tokens", "ids"), first: int | None = None, last: int | None = None
) -> DataFrame:
    """``columns`` of the documents from ``first`` to ``last``, both included; all where they are not given.

    Without ``ids`` no id is read; the bounds reach the scan, which skips the
    row groups and pages that hold none of the documents. ``start`` is the
    number of ids before a document in all files: its own ``at`` and the totals
    of the files before, of which a table with one row per file is written.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    wanted = files
    if first is not None:
        wanted = wanted.filter(F.col("doc_id") >= first)
    if last is not None:
        wanted = wanted.filter(F.col("doc_id") <= last)
    if "start" in columns:
        sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        totals = written(sizes.select(F.col("part").alias("__part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")))
        wanted = wanted.join(totals, F.col("part") == F.col("__part")).withColumn("start", F.col("__before") + F.col("at"))
    return wanted.select(*columns)


def check_sums(tokens: DataFrame, ids: str = "ids") -> DataFrame:
    """Replace the list ``ids`` by ``n_tokens``, its length, and ``ids_crc32``, the unsigned CRC-32 of its little-endian 32-bit ids."""
    others = [c for c in tokens.columns if c not in (ids, "n_tokens", "ids_crc32")]
    schema = T.StructType([*[tokens.schema[c] for c in others], T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(len(others))
            values = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B")
            at = lists.offsets.to_numpy().astype(np.int64)
            crc = [zlib.crc32(values[4 * x : 4 * y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.record_batch(
                [*b.columns[: len(others)], pa.array(np.diff(at)), pa.array(crc, pa.int64())], names=[*others, "n_tokens", "ids_crc32"]
            )

    return tokens.select(*others, ids).mapInArrow(sums, schema)
