"""Drawing documents towards a target distribution of hashed features."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.shared import text_or_empty, written

# Bytes of words (digits, letters a-z and everything beyond ASCII) stay, A-Z become a-z, the others become spaces.
_BYTES = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else ord(chr(b).lower()) if chr(b).isupper() else 0x20 for b in range(256)
)
_HALF = 1 << 33  # monotonically_increasing_id: the partition's number above these bits


@dataclass(frozen=True)
class Features:
    """Runs of 1 to ``run`` consecutive words, hashed to ``buckets``.

    A feature is frequent when it makes up at least one in ``head`` of all of
    its kind, so there are at most ``head`` frequent words and as many frequent
    pairs; only those of at most ``head_bytes`` bytes are broadcast, which
    bounds the broadcast whatever the corpus. ``kept`` is the number of
    different features that a task counts before it turns the rare ones into
    bucket counts.
    """

    run: int = 1
    buckets: int = 10_000
    head: int = 1 << 15
    head_bytes: int = 64
    kept: int = 400_000


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, with A-Z lower-cased."""
    return text.translate(_BYTES).split()


def _texts(column: pa.Array) -> Iterator[bytes]:
    """Bytes of every text; NULL is empty."""
    return (x or b"" for x in column.cast(pa.binary()).to_pylist())


class _Head(dict):
    """Exact CRC-32 states of frequent features; every other one takes the direct CRC of its bytes."""

    def __missing__(self, feature: bytes) -> int:
        return crc32(feature)


class Hasher:
    """Buckets of all features of a text.

    ``words`` are the states of frequent words and ``pairs`` those of frequent
    pairs, whose key is both words joined by a space. The state of a longer run
    goes on from the state of the run without its last word, so no run's bytes
    are joined; the rare ones cost one CRC over their last word.
    """

    def __init__(self, features: Features, words: dict[bytes, int] | None = None, pairs: dict[bytes, int] | None = None):
        self.f, self.words, self.pairs = features, _Head(words or {}), pairs or {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        states = list(map(self.words.__getitem__, words))
        found = [np.array(states, dtype=np.int64)]
        for n in range(2, min(self.f.run, len(words)) + 1):
            if n == 2 and self.pairs:
                get = self.pairs.get
                states = [s if (s := get(a + b" " + b)) is not None else crc32(b" " + b, x) for a, b, x in zip(words, words[1:], states)]
            else:
                states = [crc32(b" " + w, x) for w, x in zip(words[n - 1 :], states)]
            found.append(np.array(states, dtype=np.int64))
        return np.concatenate(found) % self.f.buckets


def n_features(n_words: int, run: int) -> int:
    return sum(max(0, n_words - k) for k in range(run))


def _tally(texts: DataFrame, features: Features) -> DataFrame:
    """Rows (kind, feature, bucket, n) of every task: its frequent words (kind 1) and pairs (2), and buckets of all other features (0)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, hashed = features, Hasher(features)
        seen: list[Counter] = [Counter(), Counter()]
        total, tail = [0, 0], np.zeros(f.buckets, dtype=np.int64)

        def keep(which: int, least: float) -> None:
            """Leave the features counted ``least`` times or more, add the others to the buckets."""
            rest = [(w, n) for w, n in seen[which].items() if n < least or len(w) > f.head_bytes]
            if rest:
                at = np.fromiter((crc32(w) for w, _ in rest), np.int64, len(rest)) % f.buckets
                np.add.at(tail, at, np.fromiter((n for _, n in rest), np.int64, len(rest)))
                for w, _ in rest:
                    del seen[which][w]

        def frequent(which: int) -> float:
            return max(1, total[which] / f.head)

        for b in batches:
            for text in _texts(b.column(0)):
                words = words_of(text)
                seen[0].update(words)
                total[0] += len(words)
                if f.run > 1:
                    seen[1].update(map(b" ".join, zip(words, words[1:])))
                    total[1] += max(0, len(words) - 1)
                if f.run > 2:
                    longer = hashed(words)[n_features(len(words), 2) :]
                    np.add(tail, np.bincount(longer, minlength=f.buckets), out=tail)
                for which in (0, 1):
                    if len(seen[which]) > f.kept:
                        keep(which, max(2, frequent(which)))
                        if 2 * len(seen[which]) > f.kept:
                            keep(which, float("inf"))
        for which in (0, 1):
            keep(which, frequent(which))
            if seen[which]:
                names, counts = list(seen[which]), list(seen[which].values())
                at = [crc32(w) % f.buckets for w in names]
                yield pa.record_batch(
                    [pa.array([which + 1] * len(names), pa.int32()), pa.array(names, pa.binary()), pa.array(at, pa.int32()), pa.array(counts, pa.int64())],
                    names=["kind", "feature", "bucket", "n"],
                )
        at = np.flatnonzero(tail)
        yield pa.record_batch(
            [pa.array(np.zeros(len(at), np.int32)), pa.nulls(len(at), pa.binary()), pa.array(at.astype(np.int32)), pa.array(tail[at])],
            names=["kind", "feature", "bucket", "n"],
        )

    return texts.mapInArrow(scan, "kind int, feature binary, bucket int, n bigint")


@dataclass
class Counts:
    """Exact totals of all buckets, and the frequent features with their states."""

    buckets: np.ndarray
    words: dict[bytes, int]
    pairs: dict[bytes, int]


def count_features(rows: DataFrame, text: str, features: Features) -> Counts:
    """Bucket totals over every feature of every text, and the head of words and pairs.

    A task counts its own words and hands on one row per frequent word and one
    per bucket for all others; these are added up by Spark. Both feed the same
    totals, which are exact whatever is in the head. The driver gets one number
    per bucket and at most ``head`` words and pairs of at most ``head_bytes``
    bytes each. Reads the texts once; an empty table gives zeros.
    """
    found = written(
        _tally(rows.select(text_or_empty(text).alias("text")), features).groupBy("kind", "feature", "bucket").agg(F.sum("n").alias("n"))
    )
    totals = np.zeros(features.buckets, dtype=np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        totals[r["bucket"]] = r["n"]
    heads: list[dict[bytes, int]] = [{}, {}]
    n_words = int(totals.sum()) if features.run == 1 else None
    for kind in (1, 2)[: features.run]:
        # At most ``head`` features can make up one in ``head`` of those counted here.
        counted = found.filter(F.col("kind") == kind)
        all_n = n_words if n_words is not None else counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        for r in counted.filter(F.col("n") * features.head >= all_n).select("feature").collect():
            feature = bytes(r["feature"])
            heads[kind - 1][feature] = crc32(feature)
    return Counts(totals, *heads)


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of every bucket, in doubles."""
    b, s_all, t_all = len(own), float(own.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b))))
            for s, t in zip(own.tolist(), target.tolist())
        ],
        dtype=np.int64,
    )


def noise(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) for a u of the row's id: Gumbel noise that is the same in every run."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def weights(docs: DataFrame, doc_id: str, text: str, features: Features, counts: Counts, gain: np.ndarray) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight``, the sum of the gains of all features of the text."""
    kind = docs.schema[doc_id].dataType.simpleString()
    head = docs.sparkSession.sparkContext.broadcast((counts.words, counts.pairs))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Hasher(features, *head.value)
        for b in batches:
            n, weight = [], []
            for text in _texts(b.column(1)):
                words = words_of(text)
                n.append(len(words))
                weight.append(int(gain[hashed(words)].sum()) if words else 0)
            sizes = np.array(n, dtype=np.int64)
            all_n = sum(np.maximum(0, sizes - k) for k in range(features.run))
            yield pa.record_batch(
                [b.column(0), pa.array(sizes), pa.array(all_n), pa.array(weight, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"]
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(scan, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``rank``, 1, 2, 3... over all rows in ``order``.

    The rows are dealt to ranges of ``order``, sorted there and written; a table
    with one row per range holds how many rows come before it. A running number
    behind ``order`` splits rows that are equal, so no range grows with them.
    ``rows`` should be a written table, as it is read for the ranges as well.
    """
    order = [*order, F.col("__row")]
    numbered = rows.withColumn("__row", F.monotonically_increasing_id())
    placed = written(
        numbered.repartitionByRange(*order).sortWithinPartitions(*order).drop("__row").withColumn("__at", F.monotonically_increasing_id())
    )
    part = F.floor(F.col("__at") / F.lit(_HALF))
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = written(sizes.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")))
    joined = placed.join(totals, part == F.col("__part"))
    return joined.withColumn("rank", F.col("__before") + F.col("__at") % F.lit(_HALF) + 1).drop("__at", "__part", "__before")


def draw(
    docs: DataFrame, target: DataFrame, percent: int = 10, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    features: Features = Features(), seed: int = 2024, min_words: int = 20,
) -> DataFrame:
    """Importance resampling of ``docs`` towards ``target`` without replacement.

    One row per document: ``doc_id``, ``n_features``, ``weight``, ``score`` and
    ``rank``. ``weight`` adds up the log ratios of the target's and the corpus's
    feature frequencies, ``score`` adds noise made of ``seed`` and the id. Of
    the documents with at least ``min_words`` words, floor(``percent``/100 of
    them) with the highest scores have a rank, ties to the smaller id; all
    others have none. NULL texts are empty, with weight 0; NULL ids share one
    noise and come last among ties, and rows that repeat an id are documents of
    their own. An empty target or an empty corpus counts as no features. Counts
    cover all texts of both tables; the corpus is read twice.
    """
    own, wanted = count_features(docs, text, features), count_features(target, target_text, features)
    weighed = weights(docs, doc_id, text, features, own, gains(own.buckets, wanted.buckets))
    scored = written(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    eligible = scored.filter(F.col("n_words") >= min_words)
    drawn = percent * eligible.count() // 100
    placed = ranked(eligible, [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("n_features"), F.col("weight")])
    names = ["doc_id", "n_features", "weight", "score"]
    shown = placed.select(*names, F.when(F.col("rank") <= drawn, F.col("rank")).cast("bigint").alias("rank"))
    rest = scored.filter(F.col("n_words") < min_words).select(*names, F.lit(None).cast("bigint").alias("rank"))
    return shown.unionAll(rest)
