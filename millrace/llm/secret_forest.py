"""Secrets in texts: candidate strings, judged by a random forest."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import chosen, text_or_empty, written
from millrace.llm.shingles import texts_as_bytes

# Runs of at least 16 signs that keys are written in, with a digit among them.
CANDIDATE = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{16,}+={0,2}+"
# What stands before the value of a secret's name: quoted values end with their quote, others with white space.
NAMED = "token|secret|api[_-]?key|access[_-]?key|private[_-]?key|passw(?:or)?d|pwd|bearer|auth"
MAY_ASSIGN = rf"""(?i)(?:{NAMED})["']?[ \t]*(?:[:=]|\bis\b)|bearer[ \t]"""
_ASSIGNS = re.compile(
    rf"""(?i)(?:{NAMED})["']?(?:[ \t]*(?::=|=>|={{1,3}}|:)|[ \t]+is(?=[ \t])|(?<=bearer)(?=[ \t]))(?:\s*(["'`])|[ \t]*)"""
)
_NAME_ALONE = re.compile(rf"(?i)(?:{NAMED})")
_QUOTED = {q: re.compile(rf"([^{q}\n]+){q}") for q in "\"'`"}
_BARE = re.compile(r"""[^\s"'`]+""")
_NEXT_FIELD = re.compile(r"[&,;][\w-]++=")
_CANDIDATE = re.compile(CANDIDATE)
# Rules that label findings for training; findings under neither are not used.
ASSIGNED = rf"""(?i)(?:{NAMED})["']?\s*(?::=|=>|=+|:|\bis\b)?\s*["'`]?$"""
# Values that are names of types, empty values, references or calls, and short words, which the forest decides on.
PLAIN = r"(?i)^(?:null|none|nil|true|false|undefined|required|optional|string|str|bytes|int|bool|number|redacted|hidden)$|^[<{%$*]|^[a-z_][a-z0-9_.]*[(\[]"
SHORT_WORD = "^[A-Za-z]{1,15}$"
HARMLESS = r"(?i)(?:commit|sha-?\d*|md5|checksum|digest|etag|build|revision|order|invoice|isbn|phone|card)\W*$"
NO_KEY = r"^[0-9]+$|^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-|^(?:x+|0+)$|(?i)example|sample|dummy|placeholder"


@dataclass(frozen=True)
class Forest:
    """``most_labelled`` bounds the findings that the forest is fitted on, and
    ``dictionary`` the frequent words that coverage is measured with; both
    tables have a fixed size, the counts behind them cover all texts."""

    trees: int = 30
    depth: int = 6
    most_labelled: int = 20_000
    dictionary: int = 4096
    context: int = 60
    threshold: float = 0.5
    seed: int = 11


def candidates(docs: DataFrame, how: Forest, doc_id: str, text: str, path: str | None) -> DataFrame:
    """``doc_id``, ``start``, ``end`` (code points, end exclusive), ``found``, ``before``, ``path``."""
    t = text_or_empty(text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), t.alias("t"), (text_or_empty(path) if path else F.lit("")).alias("path")
    ).filter(F.col("t").rlike("[A-Za-z0-9_+/-]{16}") | F.col("t").rlike(MAY_ASSIGN))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low in range(0, b.num_rows, 256):
                part = b.slice(low, 256)
                owner, found = [], []
                for i, t in enumerate(part.column(1)):
                    text = t.as_py()
                    for start, end in spans(text):
                        owner.append(i)
                        found.append((start, end, text[start:end], text[max(0, start - how.context) : start]))
                start, end, strings, before = zip(*found) if found else ((), (), (), ())
                at = pa.array(owner, pa.int64())
                yield pa.record_batch(
                    [
                        part.column(0).take(at), pa.array(start, pa.int32()), pa.array(end, pa.int32()),
                        pa.array(strings, pa.string()), pa.array(before, pa.string()), part.column(2).take(at),
                    ],
                    names=["doc_id", "start", "end", "found", "before", "path"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {kind}, start int, end int, found string, before string, path string")


def assigned(text: str) -> list[tuple[int, int]]:
    """Places of the values that are assigned to names of secrets, whatever their length and signs."""
    out: list[tuple[int, int]] = []
    for m in _ASSIGNS.finditer(text):
        start = m.end()
        if out and start < out[-1][1]:
            continue
        value = _QUOTED[m[1]].match(text, start) if m[1] else None
        if value:
            out.append(value.span(1))
            continue
        value = _BARE.match(text, start)
        if not value:
            continue
        following = _NEXT_FIELD.search(value[0])
        bare = value[0][: following.start() if following else None].rstrip(".,;:)]}>")
        # "auth: Bearer x": the scheme is no value, what follows it is.
        if bare and not _NAME_ALONE.fullmatch(bare):
            out.append((start, start + len(bare)))
    return out


def spans(text: str) -> list[tuple[int, int]]:
    """Places of candidates and of assigned values; what lies inside another one is not listed again."""
    out: list[tuple[int, int]] = []
    for start, end in sorted([*assigned(text), *(m.span() for m in _CANDIDATE.finditer(text))], key=lambda x: (x[0], -x[1])):
        if not out or end > out[-1][1]:
            out.append((start, end))
    return out


def rule_label(found: Column, before: Column) -> Column:
    """1 for strings assigned to a name of a secret, 0 for what is plainly none, NULL otherwise."""
    none = found.rlike(NO_KEY) | found.rlike(PLAIN) | before.rlike(HARMLESS)
    return F.when(none, 0).when(before.rlike(ASSIGNED) & ~found.rlike(SHORT_WORD), 1)


def transitions(docs: DataFrame, text: str) -> np.ndarray:
    """Log-probability of a byte after another one, from all texts: 256 x 256."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(65_536, dtype=np.int64)
        for b in batches:
            for raw in texts_as_bytes(b.column(0), lower=False):
                if len(raw) > 1:
                    pairs = raw[:-1].astype(np.int64) * 256 + raw[1:]
                    if len(pairs) > 20_000:
                        total += np.bincount(pairs, minlength=65_536)
                    else:
                        np.add.at(total, pairs, 1)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["pair", "n"])

    sums = docs.select(text).mapInArrow(scan, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    table = np.ones(65_536)
    if sums.num_rows:
        table[sums.column("pair").to_numpy()] += sums.column("n").to_numpy()
    table = table.reshape(256, 256)
    return np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def frequent_words(docs: DataFrame, text: str, most: int) -> frozenset[str]:
    """The words of three to twelve letters that stand in the texts most often, counted over all of them."""
    w = F.explode(F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(r"(?<![a-z])[a-z]{3,12}(?![a-z])"), F.lit(0)))
    counts = docs.select(w.alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return frozenset(r["w"] for r in counts.orderBy(F.desc("n"), "w").limit(most).select("w").collect())


NAMES = ("length", "entropy", "transition", "coverage", "digits", "upper", "hex", "switches", "quoted", "assigned", "path_code")
_KEY_WORD = re.compile(r"(?i)token|secret|key|passw|pwd|bearer|auth|credential")
_CODE_PATH = re.compile(r"(?i)\.(?:py|js|ts|java|go|rb|env|ya?ml|json|ini|cfg|conf|sh|tf|properties)$|config|secret|deploy")


def measure(found: str, before: str, path: str, log_p: np.ndarray, known: frozenset[str]) -> list[float]:
    """Features of one finding: the string itself, the words before it, and its path."""
    n = len(found)
    raw = np.frombuffer(found.encode(), dtype=np.uint8)
    runs = re.findall(r"[a-z]+", found.lower())
    kinds = [0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3 for c in found]
    near = before[-30:]
    return [
        float(n),
        -sum(k / n * math.log2(k / n) for k in Counter(found).values()),
        float(log_p[raw[:-1], raw[1:]].mean()) if len(raw) > 1 else 0.0,
        sum(len(r) for r in runs if r in known) / n,
        sum(k == 0 for k in kinds) / n,
        sum(k == 1 for k in kinds) / n,
        sum(c in "0123456789abcdefABCDEF" for c in found) / n,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        float(before[-1:] in ("\"", "'", "`")),
        float(bool(_KEY_WORD.search(near))) + 0.5 * float(bool(re.search(r"[:=]\s*[\"']?$", before))),
        float(bool(_CODE_PATH.search(path))),
    ]


def find_secrets(
    docs: DataFrame,
    how: Forest = Forest(),
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = "source",
    label: Column | None = None,
) -> DataFrame:
    """``doc_id``, ``start``, ``end``, ``found``, ``probability``, ``is_secret``: one row per candidate.

    The forest is fitted on labelled findings: those of ``label``, an expression
    over ``found`` and ``before``, or else of ``rule_label``. It judges all
    findings, so that strings in other surroundings get a verdict as well and
    false positives go. Findings for training are chosen by a hash, at most
    ``most_labelled``. Where the labels are all alike their value is the
    probability, and without labels it is 0.5. NULL and empty texts have no
    findings. Rows that repeat an id give their findings each.
    """
    found = written(candidates(docs, how, doc_id, text, path))
    log_p = transitions(docs, text)
    known = frequent_words(docs, text, how.dictionary)
    tables = docs.sparkSession.sparkContext.broadcast((log_p, known))

    def features(found: pd.Series, before: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series([measure(f, b, p, *tables.value) for f, b, p in zip(found, before, path)])

    vector = F.pandas_udf(features, "array<double>")("found", "before", "path")
    rows = written(found.withColumn("f", vector).withColumn("y", (label if label is not None else rule_label(F.col("found"), F.col("before"))).cast("double")))
    labelled = chosen(rows.filter("y IS NOT NULL"), how.most_labelled, "found", "before")
    labelled = written(labelled.select(array_to_vector("f").alias("features"), "y"))
    kinds = [r["y"] for r in labelled.select("y").distinct().collect()]
    if len(kinds) < 2:
        scored = rows.withColumn("probability", F.lit(kinds[0] if kinds else 0.5))
    else:
        forest = RandomForestClassifier(
            featuresCol="features", labelCol="y", numTrees=how.trees, maxDepth=how.depth, seed=how.seed, subsamplingRate=0.8
        ).fit(labelled.coalesce(1))
        scored = forest.transform(rows.withColumn("features", array_to_vector("f"))).withColumn(
            "probability", vector_to_array("probability")[1]
        )
    return scored.select(
        "doc_id", "start", "end", "found", "probability", (F.col("probability") >= how.threshold).alias("is_secret")
    )
