"""Hard negatives, importance resampling and token files against plain Python."""

import glob
import hashlib
import math
import random
import struct
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import hard_negatives as hn
from millrace.llm import importance as im
from millrace.llm import token_files as tf
from millrace.llm import token_ids
from millrace.llm.hard_negatives import Mining, Packed, hard_negatives
from millrace.llm.importance import Features, draw
from millrace.llm.token_files import Layout, check_sums, read_tokens, write_tokens
from millrace.llm.token_ids import TokenIds, tokenizer_file

# ---- hard negatives -------------------------------------------------------------------------------------


@pytest.mark.parametrize("top", [3, 200, 1 << 20, 1 << 40, 1 << 62])
def test_packed_products_are_exact(top):
    rng = random.Random(top)
    held = np.array([[rng.randint(-top, top) for _ in range(7)] for _ in range(2500 if top < 1 << 30 else 50)], dtype=np.int64)
    asking = [rng.randint(-top, top) for _ in range(7)]
    got = Packed(held, max(map(abs, asking))).scores(asking)
    wanted = [sum(x * y for x, y in zip(row, asking)) for row in held.tolist()]
    assert got.tolist() == [max(-hn.LARGEST, min(hn.LARGEST, x)) for x in wanted]


def test_packed_products_of_nothing():
    assert Packed(np.zeros((0, 4), np.int64), 5).scores([1, 2, 3, 4]).tolist() == []
    assert Packed(np.zeros((3, 0), np.int64), 5).scores([]).tolist() == [0, 0, 0]


def expected_negatives(rows, m=Mining()):
    """Counter-like list of output rows from (vec_id, vector, label), by plain loops."""
    kept = []
    for at, (i, v, y) in enumerate(rows):
        if y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        y = (y + 1) % 10 if i is not None and i % m.relabel_every == 0 else y
        kept.append((at, i, [math.floor(256 * x) for x in v], y))
    key = lambda s: (-s[0], s[1] is None, s[1] or 0, s[2])
    out = []
    for at, i, v, y in kept:
        if i is None or i % m.anchor_every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, k, z) for k, j, w, z in kept if k != at]
        for p in sorted((s for s in scored if s[3] == y), key=key)[: m.positives]:
            near = sorted((s for s in scored if s[3] != y and 30 * p[0] <= 100 * s[0] <= 90 * p[0]), key=key)
            out += [(i, p[1], r, n[1], p[0], n[0]) for r, n in enumerate(near[: m.negatives], 1)]
    return sorted(out, key=str)


def vector_rows(seed, n, dims=6):
    rng = random.Random(seed)
    vec = lambda: [rng.choice([-0.3, -0.1, 0.0, 0.1, 0.25, 0.5]) for _ in range(dims)]
    rows = [(i, vec(), rng.randrange(3)) for i in range(n)]
    rows += [(None, vec(), 1), (None, vec(), 2), (n, None, 1), (n + 1, vec(), None), (n + 2, [0.1, None, 0.2], 1)]
    rows += [(n + 3, [float("nan")] * dims, 1), (n + 4, [float("inf")] * dims, 0), (n + 5, [0.3] * (dims - 2), 1), (n + 6, [], 2)]
    return rows


SCHEMA = "vec_id bigint, embedding array<float>, label int"


def test_hard_negatives_against_all_pairs(spark):
    rows = vector_rows(1, 450)
    rows += [(100, rows[100][1], rows[100][2]), (205, rows[100][1], rows[100][2])]  # an anchor twice, a copy of its vector
    df = spark.createDataFrame(rows, SCHEMA)
    # Rows come in order from one partition; clashing columns and small cells must change nothing.
    odd = df.coalesce(1).withColumns({c: F.lit("x") for c in ("row", "anchor", "place", "score", "rank", "__cell", "vector")})
    small = Mining(lane_rows=100, stripe_anchors=2)
    for mining in (Mining(), small):
        got = sorted(map(tuple, hard_negatives(odd, mining=mining).collect()), key=str)
        assert got == expected_negatives(rows)


def test_hard_negatives_of_hot_copies(spark):
    """A third of all rows are one vector under one id each: ties go by id and nothing is dropped."""
    rows = vector_rows(2, 300)
    rows += [(1000 + i, rows[3][1], 1) for i in range(150)]
    got = sorted(map(tuple, hard_negatives(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()), key=str)
    assert got == expected_negatives(rows)


def test_hard_negatives_of_few_rows_and_none(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(0, [0.5, 0.5], 1), (1, [0.5, 0.4], 2), (2, [0.2, 0.2], 1), (3, [0.1, 0.2], 2), (5, [0.2, 0.1], 0)]
    assert sorted(map(tuple, hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == expected_negatives(rows)


# ---- importance resampling ------------------------------------------------------------------------------


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c >= "\x80" or c in "0123456789abcdefghijklmnopqrstuvwxyz" else " " for c in lowered).split(" ")


def expected_draw(rows, targets, run=1, buckets=10_000, percent=10):
    def of(text):
        w = [x for x in plain_words(text) if x]
        runs = [" ".join(w[i : i + n]) for n in range(1, run + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(x.encode()) % buckets for x in runs]

    own, wanted = [of(t) for _, t in rows], [of(t) for t in targets]
    s, t = [0] * buckets, [0] * buckets
    for counts, docs in ((s, own), (t, wanted)):
        for _, found in docs:
            for b in found:
                counts[b] += 1
    s_all, t_all = sum(s), sum(t)
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (s_all + buckets) / ((s[b] + 1.0) * (t_all + buckets))))
    out = []
    for (i, _), (n, found) in zip(rows, own):
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, found))
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    good = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, r in enumerate(good[: percent * len(good) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.fixture(scope="module")
def targets(corpus):
    return [t for _, t, *_ in corpus[::9]] + [None, "", "Ünder Straße 12-34 x_y " * 3]


@pytest.mark.parametrize("features", [
    Features(), Features(head=1), Features(head=50, kept=20, head_bytes=5), Features(run=2, buckets=997, head=200), Features(run=3, buckets=997, head=50, kept=40),
])
def test_draw_against_plain_python(spark, corpus, odd_docs, targets, features):
    """Whatever is in the head, and however often a task lets its rare words go, totals and weights are exact."""
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    got = sorted(map(tuple, draw(odd_docs, target, features=features).collect()), key=str)
    assert got == expected_draw([r[:2] for r in corpus], targets, features.run, features.buckets)


def test_head_is_bounded_and_broadcast(spark, docs):
    f = Features(run=2, head=300)
    counts = im.count_features(docs, "text", f)
    assert 0 < len(counts.words) <= 300 and len(counts.pairs) <= 300
    assert all(crc == zlib.crc32(w) for w, crc in [*counts.words.items(), *counts.pairs.items()])
    hashed = im.Hasher(f, counts.words, counts.pairs)
    words = [b"a", b"bc", *list(counts.words)[:5], b"a"]
    runs = [b" ".join(words[i : i + n]) for n in (1, 2) for i in range(len(words) - n + 1)]
    assert hashed(words).tolist() == [zlib.crc32(x) % f.buckets for x in runs]


def test_draw_of_empty_tables_and_long_texts(spark, no_docs):
    none = no_docs.select("text")
    assert draw(no_docs, none).collect() == []
    rows = [(1, "word " * 200_000 + "x" * 300_000), (2, None), (3, "a b c d e f g h i j k l m n o p q r s t u " * 3)]
    got = draw(spark.createDataFrame(rows, "doc_id bigint, text string"), none, percent=50)
    assert sorted(map(tuple, got.collect()), key=str) == expected_draw(rows, [], percent=50)


def test_ranks_of_equal_rows(spark):
    """A third of all rows equal: they are spread over ranges, and every rank is given once."""
    rows = im.written(spark.range(9000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).alias("score"), F.lit(1).alias("doc_id")))
    ranked = im.ranked(rows, [F.desc("score"), F.asc("doc_id")]).orderBy("rank").collect()
    assert [r.rank for r in ranked] == list(range(1, 9001))
    assert [r.score for r in ranked] == sorted((r.score for r in ranked), reverse=True)


# ---- token files ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_file())


ODD_TEXTS = [
    "", " ", "a", " a", "a ", "a  b", "a\n b", "a \nb c", "don't stop, it's", "x<|endoftext|> y <|endoftext|>", "é ü   x", "\x00 \x1c b",
    "tab\there and  two", "日本語 テキスト 123 456", "a" * 5000, "\U0001f600 \U0001f600", "end. ", "A'S 's", "퟿ \u0085 x",
]


def test_ids_are_those_of_the_tokenizer(plain):
    rng = random.Random(5)
    signs = "ab 'sté\n\t 12., <|>日"
    texts = ODD_TEXTS + ["Straße çéñ ÀÖ ſ ɐ ĳ naïve,", "ª º ²a µm"] + ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(4000)]
    to_ids = TokenIds(tokenizer_file())
    for t in texts:
        ids = plain.encode(t, add_special_tokens=False).ids
        assert to_ids(t) == struct.pack(f"<{len(ids)}I", *ids), repr(t)


def test_tokenizer_with_another_pattern():
    """Words of a tokenizer that lower-cases and has word ends are not cut out: its texts are encoded whole."""
    path = tokenizer_file("word_bpe_49k.json")
    to_ids, other = TokenIds(path), Tokenizer.from_file(path)
    for t in ["A cat, two  Cats.", "don't\nstop"]:
        ids = other.encode(t, add_special_tokens=False).ids
        assert to_ids(t) == struct.pack(f"<{len(ids)}I", *ids)


def test_kept_words_are_let_go_in_generations(monkeypatch, plain):
    monkeypatch.setattr(token_ids, "KEPT", 5)
    to_ids = TokenIds(tokenizer_file())
    for text in [f"a{i % 13} b{i % 7}, c{i % 3}.\nd{i}" for i in range(200)]:
        ids = plain.encode(text, add_special_tokens=False).ids
        assert to_ids(text) == struct.pack(f"<{len(ids)}I", *ids)
    assert max(len(to_ids.later), len(to_ids.first), len(to_ids.later.old)) <= 5


def expected_tokens(rows, plain):
    """(doc_id, n_tokens, crc) in ascending order of the id, NULL last."""
    out = []
    for i, t in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((i, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0))


@pytest.mark.parametrize("layout", [Layout(), Layout(encoding="delta", rows_per_file=20), Layout(rows_per_file=7, page_rows=2)])
def test_round_trip(spark, corpus, odd_docs, plain, tmp_path, layout):
    path = str(tmp_path / "tokens")
    write_tokens(odd_docs, path, tokenizer_file(), layout=layout)
    got = check_sums(read_tokens(spark, path)).orderBy("start").collect()
    wanted = expected_tokens([r[:2] for r in corpus], plain)
    assert [r.doc_id for r in got] == [r[0] for r in wanted]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(wanted, key=str)
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    # File by file the ids ascend too.
    names = sorted(glob.glob(f"{path}/part-*.parquet"))
    in_files = [i for n in names for i in pq.read_table(n, columns=["doc_id"]).column(0).to_pylist()]
    assert in_files == [r[0] for r in wanted]


def test_hot_id_and_null_ids_fill_many_files(spark, plain, tmp_path):
    rows = [(7, f"same id {i}") for i in range(200)] + [(None, "none")] * 150 + [(i, f"text {i}") for i in range(100)]
    path = str(tmp_path / "tokens")
    write_tokens(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), path, tokenizer_file(), layout=Layout(rows_per_file=20))
    sizes = read_tokens(spark, path, ("doc_id", "n_tokens")).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) <= 60
    got = check_sums(read_tokens(spark, path)).orderBy("start").collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(expected_tokens(rows, plain), key=str)
    keys = [(r.doc_id is None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys)


def test_file_layout(spark, tmp_path):
    """Encodings, row groups, pages and their index, as the layout says."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(300))) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for encoding in ("dictionary", "delta"):
        path = str(tmp_path / encoding)
        write_tokens(docs, path, tokenizer_file(), layout=Layout(encoding=encoding, group_bytes=200_000, page_rows=100))
        file = pq.ParquetFile(glob.glob(f"{path}/part-*.parquet")[0])
        columns = {file.metadata.row_group(0).column(i).path_in_schema: file.metadata.row_group(0).column(i) for i in range(file.metadata.num_columns)}
        assert file.metadata.num_row_groups > 1
        assert all(c.has_column_index and c.has_offset_index and c.compression == "ZSTD" for c in columns.values())
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
        ids = columns["ids.list.element"].encodings
        assert ("RLE_DICTIONARY" in ids) if encoding == "dictionary" else ("DELTA_BINARY_PACKED" in ids and "RLE_DICTIONARY" not in ids)
    with pytest.raises(ValueError):
        Layout(encoding="plain").options()


def test_selective_reads(spark, docs, tmp_path):
    path = str(tmp_path / "tokens")
    write_tokens(docs, path, tokenizer_file(), layout=Layout(rows_per_file=16))
    whole = {(r.start, r.doc_id): list(r.ids) for r in read_tokens(spark, path).collect()}
    part = read_tokens(spark, path, first=20, last=40)
    assert {(r.start, r.doc_id): list(r.ids) for r in part.collect()} == {k: v for k, v in whole.items() if k[1] is not None and 20 <= k[1] <= 40}
    narrow = read_tokens(spark, path, ("doc_id", "n_tokens"), first=20)
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1].splitlines()[0] and "GreaterThanOrEqual(doc_id,20)" in plan


def test_token_files_of_no_documents_and_long_ones(spark, no_docs, plain, tmp_path):
    write_tokens(no_docs, str(tmp_path / "none"), tokenizer_file())
    assert read_tokens(spark, str(tmp_path / "none")).collect() == []
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(99, "long text of words " * 150_000), (100, None)]
    path = str(tmp_path / "long")
    write_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"), path, tokenizer_file())
    got = check_sums(read_tokens(spark, path)).orderBy("start").collect()
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == expected_tokens(rows, plain)


def test_ids_beyond_16_bits_take_four_bytes(spark, tmp_path):
    path = str(tmp_path / "wide")
    write_tokens(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), path, tokenizer_file(), end_id=70_000)
    assert list(read_tokens(spark, path).first().ids)[-1] == 70_000


def test_batches_hold_everything():
    assert [(a, len(b)) for a, b in tf._in_batches([b"x" * tf.BATCH_BYTES, b"y", b"z"])] == [(0, 1), (1, 2)]


def test_words_before_marks_and_line_ends_go_to_the_model(monkeypatch):
    """Only marks and line ends pass through the whole tokenizer, and words are kept without the line before them."""
    seen, real = [], TokenIds._whole
    monkeypatch.setattr(TokenIds, "_whole", lambda self, text: seen.append(text) or real(self, text))
    to_ids = TokenIds(tokenizer_file())
    text = "Alpha beta### gamma.\nDelta$$$ épsilon%%%\nzeta_ it's"
    assert to_ids(text) == real(to_ids, text)
    assert not [s for s in seen if any(c.isalpha() for c in s) and s != " it's"]
    assert "gamma.\nDelta" not in " ".join(to_ids.later)
