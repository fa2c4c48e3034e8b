"""Document quality: random-indexing word vectors and a small neural network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import chosen, text_or_empty, written
from millrace.llm.shingles import mixed, texts_as_bytes, word_hashes


@dataclass(frozen=True)
class Network:
    """Sizes of the model, all fixed whatever the corpus.

    ``buckets`` x ``dims`` is the table of word vectors (4 MB, sent to every
    task). ``most_labelled`` bounds the rows that the network is fitted on;
    the word vectors are made from all texts.
    """

    buckets: int = 16_384
    dims: int = 64
    window: int = 2
    hidden: int = 32
    most_labelled: int = 20_000
    epochs: int = 40
    threshold: float = 0.3

    @property
    def inputs(self) -> int:
        """Length of a document's vector: see ``pool``."""
        return self.dims + LAGS + 2


LAGS = 4

# Letters (with all bytes of other scripts), digits, white space, and each other sign by itself.
_CLASS = np.arange(256)
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 300
_CLASS[48:58] = 301
_CLASS[[0x20, *range(0x09, 0x0E)]] = 302


def tokens(raw: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of the runs of letters, of digits and of equal signs of a text, in order."""
    if not len(raw):
        return np.zeros(0, dtype=np.int64)
    kind = _CLASS[raw]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(kind)) + 1])
    ends = np.append(starts[1:], len(raw))
    held = kind[starts] != 302
    return (word_hashes(raw, (starts[held], ends[held])) % np.uint64(buckets)).astype(np.int64)


def index_vectors(how: Network) -> tuple[np.ndarray, np.ndarray]:
    """Two places and signs of every bucket's random index vector."""
    h = mixed(np.arange(how.buckets, dtype=np.uint64) + np.uint64(77))
    place = np.stack([h % np.uint64(how.dims), (h >> np.uint64(20)) % np.uint64(how.dims)]).astype(np.int64)
    sign = np.stack([(h >> np.uint64(40)) & np.uint64(1), (h >> np.uint64(41)) & np.uint64(1)]).astype(np.int64) * 2 - 1
    return place, sign


def word_vectors(docs: DataFrame, how: Network, text: str = "text") -> np.ndarray:
    """Unit vectors of all buckets: sums of the index vectors of their neighbours in all texts.

    Each task adds up a table of its own; the tables, whole numbers, are summed
    by bucket in a shuffle, so the order of tasks does not matter. A task sends
    at most one row per bucket.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors(how)
        size = how.buckets * how.dims
        total = np.zeros(size)
        held, length = [], 0

        def add() -> None:
            x = np.concatenate(held)
            for shift in range(1, how.window + 1):
                # -1 separates texts.
                a, b = x[:-shift], x[shift:]
                for w, c in ((a, b), (b, a)):
                    ok = (w >= 0) & (c >= 0)
                    if shift > 1:
                        ok &= x[1 : len(x) - shift + 1] >= 0
                    w, c = w[ok], c[ok]
                    for k in (0, 1):
                        total[:] += np.bincount(w * how.dims + place[k][c], weights=sign[k][c], minlength=size)

        for b in batches:
            for raw in texts_as_bytes(b.column(0), lower=False):
                held += [tokens(raw, how.buckets), np.array([-1])]
                length += len(held[-2])
                if length > 500_000:
                    add()
                    held, length = [], 0
        if held:
            add()
        table = total.astype(np.int64).reshape(how.buckets, how.dims)
        used = np.flatnonzero(table.any(axis=1))
        yield pa.record_batch(
            [pa.array(used), *[pa.array(table[used, k]) for k in range(how.dims)]],
            names=["bucket", *[f"v{k}" for k in range(how.dims)]],
        )

    fields = ", ".join(f"v{k} bigint" for k in range(how.dims))
    parts = docs.select(text).mapInArrow(scan, f"bucket bigint, {fields}")
    sums = parts.groupBy("bucket").agg(*[F.sum(f"v{k}").alias(f"v{k}") for k in range(how.dims)]).toArrow()
    table = np.zeros((how.buckets, how.dims), dtype=np.float64)
    if sums.num_rows:
        at = sums.column("bucket").to_numpy()
        for k in range(how.dims):
            table[at, k] = sums.column(f"v{k}").to_numpy()
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pool(t: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean vector of a document's tokens, and how alike its tokens are.

    The last values are the mean products of the vectors of tokens one to four
    places apart, the share of distinct tokens and the logarithm of their number.
    """
    used, n = np.unique(t, return_counts=True)
    mean = (n.astype(np.float32) @ vectors[used]) / np.float32(len(t))
    alike = np.zeros(LAGS, dtype=np.float64)
    for at in range(0, len(t), 20_000):
        part = vectors[t[at : at + 20_000 + LAGS]]
        for k in range(min(LAGS, len(part) - 1)):
            own = part[: min(20_000, len(part) - 1 - k)]
            alike[k] += np.einsum("ij,ij->", own, part[k + 1 : k + 1 + len(own)])
    return np.concatenate([mean, alike / len(t), [len(used) / len(t), np.log1p(len(t))]]).astype(np.float32)


def features(docs: DataFrame, vectors: np.ndarray, how: Network, doc_id: str, text: str) -> DataFrame:
    """``doc_id`` and ``pooled``, the vector of the whole text; zeros for an empty one."""
    table = docs.sparkSession.sparkContext.broadcast(vectors)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for raw in texts_as_bytes(b.column(1), lower=False):
                t = tokens(raw, how.buckets)
                if not len(t):
                    rows.append(np.zeros(how.inputs, dtype=np.float32))
                    continue
                rows.append(pool(t, table.value))
            flat = pa.array(np.concatenate(rows) if rows else np.zeros(0, dtype=np.float32))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * how.inputs), flat)
            yield pa.record_batch([b.column(0), lists], names=["doc_id", "pooled"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(scan, f"doc_id {kind}, pooled array<float>")


@dataclass
class Fitted:
    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, tune: np.ndarray, how: Network, seed: int = 7) -> Fitted:
    """Two layers by Adam on the rows outside ``tune``; the temperature on the rows of ``tune``.

    Without labels every score is 0.5; with one label only, all scores lean to it.
    """
    rng = np.random.default_rng(seed)
    d = how.inputs
    zero = Fitted(np.zeros(d), np.ones(d), np.zeros((d, how.hidden)), np.zeros(how.hidden), np.zeros(how.hidden), 0.0, 1.0)
    fx, fy = x[~tune], y[~tune]
    if not len(fx):
        return zero
    shift, scale = fx.mean(axis=0), fx.std(axis=0) + 1e-6
    z = (fx - shift) / scale
    p = [rng.normal(0, d**-0.5, (d, how.hidden)), np.zeros(how.hidden), rng.normal(0, how.hidden**-0.5, how.hidden), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(how.epochs):
        order = rng.permutation(len(z))
        for at in range(0, len(z), 256):
            i = order[at : at + 256]
            h = np.tanh(z[i] @ p[0] + p[1])
            g = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - fy[i]) / len(i)
            back = np.outer(g, p[2]) * (1 - h * h)
            grads = [z[i].T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ g + 1e-4 * p[2], np.array([g.sum()])]
            step += 1
            for k, grad in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                p[k] = p[k] - 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    out = Fitted(shift, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    if tune.any():
        logits, ty = out.logit(x[tune]), y[tune]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        loss = [np.mean(np.logaddexp(0, -np.where(ty == 1, 1, -1) * logits / t)) for t in grid]
        out.temperature = float(grid[int(np.argmin(loss))])
    return out


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; NULL counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def quality_scores(
    docs: DataFrame, labels: DataFrame, how: Network = Network(), doc_id: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row of ``docs``.

    The score is a function of the text alone. Word vectors come from all texts.
    The network is fitted on labelled rows whose ``fold`` is not 0, at most
    ``most_labelled`` of them chosen by a hash of the id; fold 1 sets the
    temperature. Labels that are NULL are left out; of several labels of an id
    the largest counts, and of several rows of an id the one with the least
    features. Empty and NULL texts have a zero vector and a score.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    vectors = word_vectors(rows, how)
    pooled = written(features(rows, vectors, how, "doc_id", "text"))
    known = labels.filter(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("l_id")).agg(F.max(label).cast("int").alias("y"))
    known = known.withColumn("fold", fold(F.col("l_id"))).filter("fold <> 0")
    known = chosen(written(known), how.most_labelled, "l_id")
    sample = pooled.join(known, pooled["doc_id"] == known["l_id"]).groupBy("l_id", "y", "fold").agg(F.min("pooled").alias("pooled")).toPandas()
    sample = sample.sort_values("l_id", kind="stable")
    x = np.array(sample["pooled"].tolist(), dtype=np.float64).reshape(len(sample), how.inputs)
    model = fit(x, sample["y"].to_numpy(), (sample["fold"] == 1).to_numpy(), how)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False)
            s = model.score(flat.reshape(b.num_rows, how.inputs).astype(np.float64))
            yield pa.record_batch(
                [b.column(0), pa.array(s), pa.array((s >= how.threshold).astype(np.int32))], names=["doc_id", "score", "predicted"]
            )

    kind = pooled.schema["doc_id"].dataType.simpleString()
    scored = pooled.mapInArrow(scan, f"doc_id {kind}, score double, predicted int")
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")
