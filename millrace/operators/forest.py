"""Random forest on word counts, grown level by level over all trees at once.

Rows stay sparse: a row is the columns of its words, never an array over all
columns, and where it stands in a tree is found by walking the tree. Per level
one scan counts classes for the columns that each open node draws, Spark sums
them and picks the split of every node. What comes back to the driver is one row
per split, which is the model itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import staged

# Rows of a block times columns; a block has 64 rows at 2^18 columns.
CELLS = 1 << 24


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def hashed_words(words: str, n_features: int) -> Column:
    """Columns of the words of a row; NULL counts as no words."""
    return F.coalesce(F.transform(words, lambda w: F.pmod(F.hash(w), F.lit(n_features))), F.array().cast("array<int>"))


@dataclass
class Forest:
    """Nodes of all trees in one numbering; the first ``trees`` are the roots.

    A node with a split sends rows that hold ``feature`` at least ``value`` times
    to ``left + 1``, others to ``left``; a leaf has ``left`` 0. ``counts`` are
    the weights of the classes.
    """

    trees: int
    seed: int
    n_features: int
    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    counts: np.ndarray

    def blocks(self, column: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per block: its rows, the node of each row in each tree, and row, column and count of what the rows hold."""
        asked, place = np.unique(self.feature[self.left > 0], return_inverse=True)
        slot, known = np.zeros(len(self.left), dtype=np.int32), np.full(self.n_features, -1, dtype=np.int32)
        slot[self.left > 0], known[asked] = place, np.arange(len(asked))
        size = max(1, CELLS // max(self.n_features, len(asked)))
        for at in range(0, len(column), size):
            part = column.slice(at, size)
            rows = np.repeat(np.arange(len(part)), part.value_lengths().to_numpy())
            cells, held = np.unique(rows * self.n_features + part.flatten().to_numpy(), return_counts=True)
            row_of, column_of = np.divmod(cells, self.n_features)
            used = known[column_of] >= 0
            dense = np.zeros((len(part), max(1, len(asked))), dtype=np.int32)
            dense[row_of[used], known[column_of[used]]] = held[used]
            nodes = np.tile(np.arange(self.trees), (len(part), 1))
            row, tree = np.nonzero(self.left[nodes] > 0)
            here = nodes[row, tree]
            while len(row):
                here = self.left[here] + (dense[row, slot[here]] >= self.value[here])
                nodes[row, tree] = here
                more = self.left[here] > 0
                row, tree, here = row[more], tree[more], here[more]
            yield slice(at, at + len(part)), nodes, row_of, column_of, held

    def weights(self, ids: np.ndarray) -> np.ndarray:
        """How often each tree draws each row: Poisson with mean 1, by the row's number alone."""
        cells = ids.astype(np.uint64)[:, None] * np.uint64(self.trees) + np.arange(self.trees, dtype=np.uint64)
        share = (_mixed(cells + _mixed(np.array([self.seed], dtype=np.uint64))) >> np.uint64(11)) / 2.0**53
        below = np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 12)]))
        return np.searchsorted(below, share, "right")

    def transform(self, df: DataFrame, words: str) -> DataFrame:
        """All columns and ``prediction``, the class with the largest sum of the trees' shares."""
        share = self.counts / np.maximum(self.counts.sum(axis=1, keepdims=True), 1)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = [share[nodes].sum(axis=1).argmax(axis=1) for _, nodes, *_ in self.blocks(b.column(b.num_columns - 1))]
                found = np.concatenate([*found, np.zeros(0, dtype=np.int64)]).astype(np.float64)
                yield pa.record_batch([*b.columns[:-1], pa.array(found)], names=[*b.schema.names[:-1], "prediction"])

        schema = T.StructType([*df.schema.fields, T.StructField("prediction", T.DoubleType())])
        return df.select("*", hashed_words(words, self.n_features).alias("__held")).mapInArrow(scan, schema)


def _root_counts(rows: DataFrame, forest: Forest) -> np.ndarray:
    """Weights of the classes per tree."""
    n = forest.counts.shape[1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, forest.trees), dtype=np.int64)
        for b in batches:
            np.add.at(total, b.column(1).to_numpy(), forest.weights(b.column(0).to_numpy()))
        kind, tree = np.indices(total.shape)
        yield pa.record_batch([pa.array(x.ravel()) for x in (tree, kind, total)], names=["tree", "kind", "w"])

    found = rows.select("id", "kind").mapInArrow(scan, "tree bigint, kind bigint, w bigint").groupBy("tree", "kind").agg(F.sum("w").alias("w"))
    out = np.zeros_like(forest.counts)
    for r in found.collect():
        out[r.tree, r.kind] = r.w
    return out


def _class_counts(rows: DataFrame, forest: Forest, is_open: np.ndarray, level: int, parts: int) -> DataFrame:
    """(node, feature, value, kind, w): drawn columns that rows of open nodes hold; what is not held is the rest of the node's weight.

    Every level deals the columns into ``parts`` by hash, and a node draws one
    part. A row's columns are put in the order of parts, so that the drawn ones
    are found without looking at the others.
    """
    salt = np.uint64((forest.seed << 40) + (level << 32))
    draw = (_mixed(np.arange(len(is_open), dtype=np.uint64) ^ ~salt) % np.uint64(parts)).astype(np.int64)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, kinds = b.column(0).to_numpy(), b.column(1).to_numpy()
            for block, nodes, row, column, held in forest.blocks(b.column(2)):
                weight = forest.weights(ids[block])
                key = row * parts + (_mixed(column.astype(np.uint64) ^ salt) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(key, kind="stable")
                first = np.concatenate([[0], np.cumsum(np.bincount(key, minlength=len(nodes) * parts))])
                at, tree = np.nonzero(is_open[nodes] & (weight > 0))
                wanted = at * parts + draw[nodes[at, tree]]
                n = first[wanted + 1] - first[wanted]
                pair = np.repeat(np.arange(len(n)), n)
                entry = order[first[wanted][pair] + np.arange(len(pair)) - (np.cumsum(n) - n)[pair]]
                at, tree = at[pair], tree[pair]
                out = (nodes[at, tree], column[entry], held[entry], kinds[block][at], weight[at, tree])
                yield pa.record_batch([pa.array(x.astype(np.int32)) for x in out], names=["node", "feature", "value", "kind", "w"])

    return rows.mapInArrow(scan, "node int, feature int, value int, kind int, w int")


def _gini(sides: list[Column]) -> Column:
    """Weight of a side times its impurity."""
    total = sum(sides[1:], sides[0])
    return total - sum([s * s for s in sides[1:]], sides[0] * sides[0]) / total


def _best_splits(found: DataFrame, totals: DataFrame, n: int) -> DataFrame:
    """The split of every open node that lowers the impurity most: node, feature, value and the classes on its right side.

    A node's rows meet once and all that follows is done where they are: a node
    draws so few columns that even a root has less than one entry per row.
    """
    per_value = found.repartition("node").groupBy("node", "feature", "value").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("w")).otherwise(0)).cast("double").alias(f"w{k}") for k in range(n)]
    )
    from_above = Window.partitionBy("node", "feature").orderBy(F.col("value").desc())
    right = per_value.select("node", "feature", "value", *[F.sum(f"w{k}").over(from_above).alias(f"r{k}") for k in range(n)])
    both = right.join(F.broadcast(totals), "node")
    rights, lefts = [F.col(f"r{k}") for k in range(n)], [F.col(f"t{k}") - F.col(f"r{k}") for k in range(n)]
    gain = _gini([F.col(f"t{k}") for k in range(n)]) - _gini(lefts) - _gini(rights)
    able = both.filter(sum(lefts[1:], lefts[0]) > 0).withColumn("gain", F.round(gain, 9)).filter("gain > 0")
    best = able.groupBy("node").agg(F.max(F.struct("gain", "feature", "value", *[f"r{k}" for k in range(n)])).alias("x"))
    return best.select("node", "x.*")


def grow(train: DataFrame, words: str, label: str, trees: int, seed: int, n_features: int, max_depth: int) -> Forest:
    """Grow ``trees`` trees on rows drawn with repeats. Runs two jobs and one more per level.

    Each node draws about the square root of ``n_features`` columns. A node
    without a split that helps is a leaf, also where it is ``max_depth`` splits
    deep. Rows without a label take no part.
    """
    spark = train.sparkSession
    rows = staged(
        train.filter(F.col(label).isNotNull()).select(
            F.col(label).cast("int").alias("kind"), hashed_words(words, n_features).alias("held")
        ).repartition(4 * spark.sparkContext.defaultParallelism).select(F.monotonically_increasing_id().alias("id"), "kind", "held")
    )
    n = int(rows.agg(F.max("kind")).first()[0] or 0) + 1
    forest = Forest(trees, seed, n_features, *[np.zeros(trees, dtype=np.int32) for _ in range(3)], np.zeros((trees, n)))
    forest.counts = _root_counts(rows, forest)
    first = 0
    for level in range(max_depth):
        known = len(forest.left)
        is_open = (np.arange(known) >= first) & (np.count_nonzero(forest.counts, axis=1) > 1)
        if not is_open.any():
            break
        at = np.flatnonzero(is_open)
        totals = pa.table({"node": pa.array(at.astype(np.int32)), **{f"t{k}": forest.counts[at, k] for k in range(n)}})
        found = _class_counts(rows, forest, is_open, level, max(1, round(n_features**0.5)))
        splits = _best_splits(found, spark.createDataFrame(totals), n).toArrow()
        if not splits.num_rows:
            break
        splits = splits.sort_by("node")
        node = splits["node"].to_numpy()
        right = np.stack([splits[f"r{k}"].to_numpy() for k in range(n)], axis=1)
        forest.feature[node], forest.value[node] = splits["feature"].to_numpy(), splits["value"].to_numpy()
        forest.left[node] = known + 2 * np.arange(len(node))
        new = np.stack([forest.counts[node] - right, right], axis=1).reshape(-1, n)
        forest.counts = np.concatenate([forest.counts, new])
        forest.feature, forest.value, forest.left = (np.concatenate([x, np.zeros(len(new), dtype=np.int32)]) for x in (forest.feature, forest.value, forest.left))
        first = known
    return forest
