"""Hard negatives of anchor vectors by exact integer products."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.shared import written

# Candidates packed into one integer: their fields stay in the first-level caches while an anchor is multiplied.
PACK = 2_048
LARGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Mining:
    """``anchor_every``: rows whose id it divides are anchors. ``low`` and ``high``: per cent of a positive's score."""

    anchor_every: int = 100
    relabel_every: int = 7
    labels: int = 10
    scale: float = 256.0
    positives: int = 5
    negatives: int = 10
    positive_part: int = 30
    negative_part: int = 100
    upper_part: int = 90
    lane_rows: int = 1 << 16
    stripe_anchors: int = 1 << 12
    cells: int = 24


class Packed:
    """Exact products of anchors with many candidates, ``PACK`` of them in one integer for every component.

    Candidates' components are raised by the lowest of them, so none is negative,
    and stand in fields of a fixed number of bytes side by side in one wide
    integer. An anchor multiplies it once per component and adds up; a constant
    that keeps every field positive is added, and each field is then the raised
    score of one candidate. Fields are as wide as the largest score that the
    components allow, so nothing runs over into the next one: 4 or 8 bytes for
    usual vectors, more where components are huge.
    """

    def __init__(self, candidates: np.ndarray, largest_anchor: int):
        self.n, dims = candidates.shape
        self.bias = max(0, -int(candidates.min())) if candidates.size else 0
        top = int(candidates.max()) + self.bias if candidates.size else 0
        self.raised = dims * max(1, largest_anchor) * max(1, top)
        bits = (2 * self.raised).bit_length()
        self.bytes = 4 if bits <= 32 else 8 if bits <= 63 else -(-bits // 8)
        self.packs = []
        for at in range(0, self.n, PACK):
            block = candidates[at : at + PACK]
            self.packs.append((len(block), [self._wide(block[:, i]) for i in range(dims)], self._constant(len(block))))

    def _wide(self, values: np.ndarray) -> int:
        if self.bytes <= 8:
            return int.from_bytes((values.astype(np.int64) + self.bias).astype(f"<u{self.bytes}").tobytes(), "little")
        return int.from_bytes(b"".join((int(x) + self.bias).to_bytes(self.bytes, "little") for x in values), "little")

    def _constant(self, n: int) -> int:
        return int.from_bytes(self.raised.to_bytes(self.bytes, "little") * n, "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Inner products with all candidates, in their order; those beyond 64 bits are the largest or smallest integer there."""
        out = []
        shift = self.raised + self.bias * sum(anchor)
        for n, wide, constant in self.packs:
            fields = (sum(map(mul, wide, anchor)) + constant).to_bytes(n * self.bytes, "little")
            if self.bytes <= 8:
                out.append(np.frombuffer(fields, f"<u{self.bytes}").astype(np.int64) - shift)
            else:
                size = self.bytes
                exact = (int.from_bytes(fields[k : k + size], "little") - shift for k in range(0, n * size, size))
                out.append(np.array([max(-LARGEST, min(LARGEST, x)) for x in exact], dtype=np.int64))
        return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def _matrix(table: pa.Table, scale: float) -> np.ndarray:
    """floor(scale * x) of the vectors as 64-bit integers; short vectors end in zeros."""
    lists = table.column("vector").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    at = lists.offsets.to_numpy().astype(np.int64)
    with np.errstate(over="ignore"):
        flat = np.floor(scale * lists.values.to_numpy(zero_copy_only=False).astype(np.float64))
    whole = np.clip(flat, -(2.0**62), 2.0**62).astype(np.int64)
    sizes = np.diff(at)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        out[rows, :n] = whole[at[rows][:, None] + np.arange(n)]
    return out


def _vectors(candidates: pa.Table, anchors: pa.Table, scale: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Both matrices with as many components, and the largest component of an anchor."""
    pair = [_matrix(candidates, scale), _matrix(anchors, scale)]
    dims = max(x.shape[1] for x in pair)
    held, asking = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in pair)
    return held, asking, int(np.abs(asking).max(initial=0))


class _Order:
    """Candidates in the order that ends ties: smaller ids first, NULL ids last."""

    def __init__(self, table: pa.Table):
        ids = table.column("vec_id").combine_chunks()
        self.unknown = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.row = table.column("row").to_numpy()

    def first(self, at: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` of the candidates ``at`` with the highest scores."""
        if len(at) > 4 * n:
            least = np.partition(scores[at], len(at) - n)[len(at) - n]
            at = at[scores[at] >= least]
        return at[np.lexsort((self.row[at], self.ids[at], self.unknown[at], -scores[at]))][:n]

    def name(self, i: int) -> int | None:
        return None if self.unknown[i] else int(self.ids[i])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _positives(m: Mining):
    """Function of a cell: the first rows of each anchor's own label in the cell."""
    schema = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("score", pa.int64()), ("row", pa.int64())])

    def cell(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if candidates.num_rows and anchors.num_rows:
            held, asking, largest = _vectors(candidates, anchors, m.scale)
            order, labels = _Order(candidates), candidates.column("label").to_numpy()
            own, rows = anchors.column("label").to_numpy(), anchors.column("row").to_numpy()
            for label in np.unique(own):
                same = np.flatnonzero(labels == label)
                packed = Packed(held[same], largest)
                scores = np.zeros(len(labels), dtype=np.int64)
                for a in np.flatnonzero(own == label) if len(same) else ():
                    scores[same] = packed.scores(asking[a].tolist())
                    others = same[order.row[same] != rows[a]]
                    out += [(int(rows[a]), order.name(i), int(scores[i]), int(order.row[i])) for i in order.first(others, scores, m.positives)]
        return _table(out, schema)

    return cell, "anchor bigint, id bigint, score bigint, row bigint"


def _negatives(m: Mining):
    """Function of a cell: for each anchor and positive the first rows of other labels within the positive's band."""
    schema = pa.schema([("anchor", pa.int64()), ("place", pa.int32()), ("id", pa.int64()), ("score", pa.int64()), ("row", pa.int64())])

    def cell(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if candidates.num_rows and anchors.num_rows:
            held, asking, largest = _vectors(candidates, anchors, m.scale)
            order, labels = _Order(candidates), candidates.column("label").to_numpy()
            own, rows = anchors.column("label").to_numpy(), anchors.column("row").to_numpy()
            bands = anchors.column("scores").to_pylist()
            packed = Packed(held, largest)
            for a in range(len(rows)):
                scores = packed.scores(asking[a].tolist())
                other = np.flatnonzero(labels != own[a])
                found: dict[int, np.ndarray] = {}
                for place, p in enumerate(bands[a], 1):
                    if p not in found:
                        # positive_part * p <= negative_part * score <= upper_part * p, without a product that leaves 64 bits
                        low, high = -(-m.positive_part * p // m.negative_part), m.upper_part * p // m.negative_part
                        inside = other[(scores[other] >= low) & (scores[other] <= high)] if low <= high else other[:0]
                        found[p] = order.first(inside, scores, m.negatives)
                    out += [(int(rows[a]), place, order.name(i), int(scores[i]), int(order.row[i])) for i in found[p]]
        return _table(out, schema)

    return cell, "anchor bigint, place int, id bigint, score bigint, row bigint"


def _usable(vector: str) -> Column:
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return v.isNotNull() & ~bad


def _by_score(*keys: str) -> Window:
    return Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), F.asc("row"))


def hard_negatives(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", mining: Mining = Mining()
) -> DataFrame:
    """Rows of other labels that score close below an anchor's positives.

    Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score`` and ``negative_score``. A score is the inner product of
    floor(scale * component); higher ones come first, ties by the smaller id.
    An anchor's positives are its first ``positives`` other rows of the same
    label; each of them gets the first ``negatives`` rows of other labels whose
    score lies in the band that its own score spans. Where an id is divisible
    by ``relabel_every`` the label moves on by one.

    Rows with a NULL label or vector or a NULL or non-finite component take no
    part. A NULL id keeps its label, is no anchor, and comes last among ties.
    Rows that repeat an id are rows of their own, as anchors too; an anchor is
    no partner of its own row. Missing components of shorter vectors count as
    zero; scores beyond 64 bits are the largest or smallest integer there. An
    empty table gives no rows.

    Anchors are compared with all rows in cells: rows are dealt to lanes and
    anchors to stripes by a hash of a row number, so equal rows spread, and a
    cell holds at most about ``lane_rows`` rows and ``stripe_anchors`` anchors.
    Positives multiply only rows of the anchor's own label. Each cell hands on
    its best few rows, and Spark keeps the best of all cells. Counts the rows
    once and writes them once with their numbers.
    """
    m = mining
    moved = F.when(F.col(vec_id) % m.relabel_every == 0, (F.col(label) + 1) % m.labels).otherwise(F.col(label))
    kept = vectors.filter(F.col(label).isNotNull() & _usable(vector))
    rows = written(
        kept.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("vector"), moved.cast("bigint").alias("label")).withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    anchors = rows.filter(F.col("vec_id") % m.anchor_every == 0)
    n_rows, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % m.anchor_every == 0)).first()
    stripes = max(1, -(-n_anchors // m.stripe_anchors))
    lanes = max(1, -(-n_rows // m.lane_rows), min(-(-m.cells // stripes), -(-n_rows // 1024)))

    def dealt(side: DataFrame, own: int, others: int, is_anchor: bool) -> DataFrame:
        place, other = F.pmod(F.xxhash64("row"), F.lit(own)), F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        spread = side.withColumn("__place", place).withColumn("__other", other)
        lane, stripe = ("__other", "__place") if is_anchor else ("__place", "__other")
        return spread.withColumn("__cell", F.col(lane) * F.lit(stripes) + F.col(stripe)).drop("__place", "__other")

    def over_cells(asking: DataFrame, cell, schema: str) -> DataFrame:
        held = dealt(rows, lanes, stripes, False)
        # Both sides come from one table; a cogroup needs columns of their own on each.
        ask = dealt(asking.select(*[F.col(c).alias(c) for c in asking.columns]), stripes, lanes, True)
        return held.groupBy("__cell").cogroup(ask.groupBy("__cell")).applyInArrow(cell, schema)

    near = over_cells(anchors, *_positives(m)).withColumn("place", F.row_number().over(_by_score("anchor"))).filter(F.col("place") <= m.positives)
    positives = written(near.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    # At most ``positives`` scores for an anchor, in the order of their places.
    lists = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    asking = anchors.join(lists, F.col("row") == F.col("anchor")).select("row", "label", "vector", F.col("p.positive_score").alias("scores"))
    found = over_cells(asking, *_negatives(m)).withColumn("rank", F.row_number().over(_by_score("anchor", "place"))).filter(F.col("rank") <= m.negatives)
    named = found.join(positives, ["anchor", "place"]).join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    return named.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
