"""Repeated passages: runs of consecutive sentences that occur more than once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import text_or_empty, written
from millrace.llm.shingles import mixed, texts_as_bytes, word_bounds, word_hashes

_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(b".!?;:,")] = True
# Ends of other scripts: two bytes (Arabic, Greek) and three (ellipses, Devanagari, CJK and full width).
_WIDE_ENDS = {n: np.array([int.from_bytes(c.encode()) for c in s]) for n, s in ((2, "؟،؛۔;"), (3, "…‥‼⁇⁈⁉।॥。、！？；：，．｡､"))}


@dataclass(frozen=True)
class Spans:
    """A span has at least ``sentences`` sentences and ``words`` words.

    Sentences are the parts between full stops, question and exclamation marks,
    commas, colons, semicolons, their forms in other scripts and line ends, so
    that a passage put into another text keeps most of its sentences whole. A
    sentence of more than ``long`` words is cut behind about one word in
    ``piece``, chosen by the words alone, and its pieces count as sentences.
    """

    sentences: int = 2
    words: int = 20
    long: int = 20
    piece: int = 8


@dataclass
class Cut:
    """Sentences of a text as byte offsets, and its spans by their first and last sentence."""

    starts: np.ndarray  # first byte of each sentence
    n_words: np.ndarray
    keys: np.ndarray  # hash of a span
    at: np.ndarray  # its first sentence
    until: np.ndarray  # sentence behind it


def _ends(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether a sentence ends with a word."""
    ends = _ENDS[raw[last - 1]]
    if (raw[last - 1] > 127).any():
        for n, marks in _WIDE_ENDS.items():
            long = np.flatnonzero(last - first >= n)
            code = sum(raw[last[long] - n + k].astype(np.int64) << 8 * (n - 1 - k) for k in range(n))
            ends[long] |= np.isin(code, marks)
    return ends


def cut(raw: np.ndarray, how: Spans) -> Cut:
    """Sentences and spans of one text; a text that is too short has no spans."""
    first, last = word_bounds(raw)
    n = len(first)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Cut(none, none, none.astype(np.uint64), none, none)
    lines = np.concatenate([[0], np.cumsum(raw == 10)])
    ends = _ends(raw, first, last)
    ends[:-1] |= lines[first[1:]] > lines[last[:-1]]
    ends[-1] = True
    hashes = word_hashes(raw)
    behind = np.flatnonzero(ends) + 1
    begin = np.concatenate([[0], behind[:-1]])
    if (behind - begin).max() > how.long:
        # A repeated word is no place to cut at.
        spread = mixed(hashes[1:] + _BASE * hashes[:-1]) % np.uint64(how.piece)
        ends[1:] |= (spread == 0) & (hashes[1:] != hashes[:-1]) & np.repeat(behind - begin > how.long, behind - begin)[1:]
        behind = np.flatnonzero(ends) + 1
        begin = np.concatenate([[0], behind[:-1]])
    count = len(begin)
    every = np.arange(count)
    # Of the runs that are long enough the shortest that begins, and the shortest that ends, at each sentence:
    # every sentence of a longer run is in one of those inside it.
    until = np.maximum(np.searchsorted(behind, begin + how.words, side="left"), every + how.sentences - 1) + 1
    since = np.minimum(np.searchsorted(begin, behind - how.words, side="right") - 1, every - how.sentences + 1)
    held, ending = np.flatnonzero(until <= count), np.flatnonzero(since >= 0)
    both = np.unique(np.concatenate([held * (count + 1) + until[held], since[ending] * (count + 1) + ending + 1]))
    at, until = both // (count + 1), both % (count + 1)
    powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BASE))]).astype(np.uint64)
    inverses = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _INVERSE))]).astype(np.uint64)
    running = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers[:n])]).astype(np.uint64)
    s, e = begin[at], behind[until - 1]
    keys = mixed((running[e] - running[s]) * inverses[s] + (e - s).astype(np.uint64))
    return Cut(first[begin], behind - begin, keys, at, until)


def cut_table(docs: DataFrame, how: Spans, doc_id: str, text: str) -> DataFrame:
    """``row``, ``doc_id``, ``text``, ``n_sentences`` and ``spans``, the hashes of all spans by first and last sentence. Written."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low in range(0, b.num_rows, 256):
                part = b.slice(low, 256)
                found = [cut(raw, how) for raw in texts_as_bytes(part.column(2))]
                ends = np.cumsum([0, *(len(c.keys) for c in found)], dtype=np.int32)
                keys = np.concatenate([c.keys for c in found]).view(np.int64)
                yield pa.record_batch(
                    [
                        part.column(0), part.column(1), part.column(2), pa.array([len(c.starts) for c in found], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(keys)),
                    ],
                    names=["row", "doc_id", "text", "n_sentences", "spans"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    return written(rows.mapInArrow(scan, f"row bigint, doc_id {kind}, text string, n_sentences bigint, spans array<bigint>"))


def drop_repeated(
    docs: DataFrame, how: Spans = Spans(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``text`` without repeated passages, ``n_sentences``, ``n_removed``, ``removed_words``.

    A span is repeated when it occurs twice or more in all texts. Its first
    occurrence, by ``doc_id``, row and place, stays; the sentences of all others
    go, and the rest of the text stays as it was. Words are compared with A-Z
    lower-cased. Rows that share a ``doc_id`` are documents of their own, the
    first of which keeps what all of them hold; which of them is first follows
    the order in which ``docs`` is read. A NULL ``doc_id`` comes before all
    others. NULL and empty texts come out empty.

    Texts are cut once and written with a row number and the hashes of their
    spans. Spans are counted before the shuffle; only occurrences of those that
    repeat go on, with hot ones split by AQE, and a row gets the list of its own
    repeated places, which is no longer than its text. Rows with such a list are
    cut again to take the sentences out.
    """
    cuts = cut_table(docs, how, doc_id, text)
    spans = cuts.select("row", "doc_id", F.posexplode("spans").alias("at", "span"))
    repeated = written(spans.groupBy("span").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("span"))
    found = written(spans.join(repeated, "span"))
    first = written(
        found.groupBy("span").agg(F.min(F.struct("doc_id", "row", "at")).alias("f")).select("span", F.col("f.row").alias("f_row"), F.col("f.at").alias("f_at"))
    )
    later = found.join(first, "span").filter((F.col("row") != F.col("f_row")) | (F.col("at") != F.col("f_at")))
    lists = written(later.groupBy(F.col("row").alias("l_row")).agg(F.sort_array(F.collect_list("at")).alias("gone")))
    joined = cuts.drop("spans").join(lists, F.col("row") == F.col("l_row"), "left").select("doc_id", "text", "n_sentences", "gone")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low in range(0, b.num_rows, 256):
                part = b.slice(low, 256)
                out = [_without(*x, how) for x in zip(part.column(1), part.column(3).to_pylist())]
                texts, gone, words = zip(*out)
                yield pa.record_batch(
                    [part.column(0), pa.array(texts, pa.string()), part.column(2), *[pa.array(x, pa.int64()) for x in (gone, words)]],
                    names=["doc_id", "text", "n_sentences", "n_removed", "removed_words"],
                )

    kind = cuts.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        clean, f"doc_id {kind}, text string, n_sentences bigint, n_removed bigint, removed_words bigint"
    )


def _without(text: pa.StringScalar, at: list[int] | None, how: Spans) -> tuple[str, int, int]:
    """The text without the sentences of its spans at the given places, and how many sentences and words that are."""
    if not at:
        return text.as_py(), 0, 0
    raw = next(texts_as_bytes(pa.array([text.as_py()]), lower=False))
    found = cut(next(texts_as_bytes(pa.array([text.as_py()]))), how)
    gone = np.zeros(len(found.starts) + 1, dtype=np.int64)
    np.add.at(gone, found.at[at], 1)
    np.subtract.at(gone, found.until[at], 1)
    covered = np.cumsum(gone[:-1]) > 0
    edges = np.append(found.starts, len(raw))
    kept = [raw[: edges[0]].tobytes()]
    kept += [raw[edges[i] : edges[i + 1]].tobytes() for i in np.flatnonzero(~covered)]
    return b"".join(kept).decode(), int(covered.sum()), int(found.n_words[covered].sum())
