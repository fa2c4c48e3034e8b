"""Packing documents into sequences of tokens by best fit and local search."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import text_or_empty
from millrace.llm.token_ids import token_ids

LENGTH = 1024
END_ID = 2
# Documents packed together: a shard's rows (about 60 bytes each) fit any task,
# and the last, partly filled sequence of a shard is a small share of its sequences.
SHARD_DOCS = 16_384


def cut_points(n: int, length: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens: the first one takes what the others leave."""
    first = n % length or min(n, length)
    return [(0, first), *[(at, length) for at in range(first, n, length)]]


def pieces(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` of every document and its end token."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = token_ids(tokenizer)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                owner, piece, start, size, crc = [], [], [], [], []
                for i, text in enumerate(part.column(1)):
                    ids = to_ids(text.as_py()) + end
                    for k, (s, n) in enumerate(cut_points(len(ids) // 4, length)):
                        owner.append(i)
                        piece.append(k)
                        start.append(s)
                        size.append(n)
                        crc.append(zlib.crc32(ids[4 * s : 4 * (s + n)]))
                yield pa.record_batch(
                    [
                        part.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(doc_id, text_or_empty(text).alias("text"))
    return rows.mapInArrow(scan, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Bins of indices: the largest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(length + 1)]
    for i in np.argsort(-sizes, kind="stable").tolist():
        n = int(sizes[i])
        gap = next((g for g in range(n, length + 1) if room[g]), None)
        if gap is None:
            bins.append([])
            at, gap = len(bins) - 1, length
        else:
            at = room[gap].pop()
        bins[at].append(i)
        room[gap - n].append(at)
    return bins


class Search:
    """Underfull bins, found by the gaps they have and by the sizes of their documents."""

    def __init__(self, bins: list[list[int]], sizes: np.ndarray, length: int):
        self.bins, self.sizes, self.length = bins, sizes.tolist(), length
        self.fill = [sum(self.sizes[i] for i in b) for b in bins]
        self.by_gap: dict[int, dict[int, None]] = {}
        self.by_size: dict[int, dict[int, None]] = {}
        self.used = sum(map(bool, self.fill))
        self.stuck: set[int] = set()  # sizes that found no bin in this pass
        for b in range(len(bins)):
            self._enter(b)

    def is_open(self, b: int) -> bool:
        return 0 < self.fill[b] < self.length

    def _enter(self, b: int) -> None:
        if self.is_open(b):
            self.by_gap.setdefault(self.length - self.fill[b], {})[b] = None
            for i in self.bins[b]:
                self.by_size.setdefault(self.sizes[i], {})[b] = None

    def _leave(self, b: int) -> None:
        gap = self.length - self.fill[b]
        del self.by_gap[gap][b]
        if not self.by_gap[gap]:
            del self.by_gap[gap]
        for n in {self.sizes[i] for i in self.bins[b]}:
            del self.by_size[n][b]

    def step(self, source: int) -> bool:
        """One move or exchange that takes tokens from ``source`` and raises the sum of squared fills."""
        widest = max((g for g in self.by_gap if len(self.by_gap[g]) > (source in self.by_gap[g])), default=0)
        for i in sorted(self.bins[source], key=lambda x: -self.sizes[x]):
            if self.sizes[i] in self.stuck:
                continue
            for target, back in self._targets(source, self.sizes[i], widest):
                shift = self.sizes[i] - sum(self.sizes[j] for j in back)
                # Squares grow when the target ends up fuller than the source was.
                if target != source and shift <= self.length - self.fill[target] and self.fill[target] + shift > self.fill[source]:
                    self._exchange(source, i, target, back, shift)
                    return True
            self.stuck.add(self.sizes[i])
        return False

    def _targets(self, source: int, n: int, widest: int) -> Iterator[tuple[int, list[int]]]:
        """Bins for a document of ``n`` tokens, with what they would give back: nothing, one or two documents."""
        for gap in sorted(g for g in self.by_gap if g >= n):
            yield from ((b, []) for b in self.by_gap[gap])
        for shift in range(min(widest, n - 1), 0, -1):
            for b in self.by_size.get(n - shift, ()):
                yield b, [next(j for j in self.bins[b] if self.sizes[j] == n - shift)]
        for gap in sorted(self.by_gap, reverse=True):
            for b in self.by_gap[gap]:
                held = sorted(self.bins[b], key=lambda j: self.sizes[j])
                for x, j in enumerate(held):
                    for k in held[:x]:
                        if n - gap <= self.sizes[j] + self.sizes[k] < n:
                            yield b, [j, k]

    def _exchange(self, source: int, i: int, target: int, back: list[int], shift: int) -> None:
        self._leave(source)
        self._leave(target)
        self.bins[source].remove(i)
        for j in back:
            self.bins[target].remove(j)
        self.bins[source] += back
        self.bins[target].append(i)
        self.fill[source] -= shift
        self.fill[target] += shift
        self.used -= not self.fill[source]
        self._enter(source)
        self._enter(target)


def local_search(bins: list[list[int]], sizes: np.ndarray, length: int) -> list[list[int]]:
    """Empty bins by moves and by exchanges of one document for one or two between underfull bins.

    Bins are taken from the emptiest up, again and again until a pass gains
    nothing; a size that found no bin is not tried again in the same pass. Every
    step raises the sum of squared fills, so the search ends; it stops as soon
    as no fewer bins can hold the total.
    """
    search = Search(bins, sizes, length)
    fewest = -(-sum(search.fill) // length)
    gained = True
    while gained:
        gained = False
        search.stuck.clear()
        for source in sorted(range(len(bins)), key=lambda b: search.fill[b]):
            while search.is_open(source) and search.used > fewest and search.step(source):
                gained = True
    return [b for b in bins if b]


def pack(parts: DataFrame, shards: int, length: int = LENGTH) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces.

    Pieces are dealt to shards by a hash of a running number, so rows that repeat
    spread like any others, and each shard packs its own: best fit first, then
    local search over the bins it left underfull. Full pieces are sequences by
    themselves. Ties go by document, piece and check sum, so runs over the same
    partitions agree. Only ids, lengths and check sums are shuffled.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    schema = f"{fields}, sequence_id bigint, offset bigint"

    def one_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        sizes = rows["length"].to_numpy()
        bins = local_search(best_fit(sizes, length), sizes, length)
        order = np.concatenate([np.array(b) for b in bins])
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        before = np.concatenate([np.cumsum(sizes[b]) - sizes[b] for b in bins])
        out = rows.iloc[order].reset_index(drop=True)
        out["sequence_id"] = number * np.int64(shards) + key[0]
        out["offset"] = before
        return out.drop(columns="shard")

    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))
    return parts.withColumn("shard", place).groupBy("shard").applyInPandas(one_shard, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A document is its ids and the end token; only those longer than a sequence
    are cut. NULL and empty texts are the end token alone. Rows that repeat an
    id are packed as separate documents. Counts the rows once, for the number
    of shards; an empty table gives no rows.
    """
    shards = max(1, -(-docs.count() // SHARD_DOCS))
    return pack(pieces(docs, tokenizer, doc_id, text, length, end_id), shards, length)
