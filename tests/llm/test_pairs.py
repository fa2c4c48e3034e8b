"""Near-duplicate groups and repeated spans against plain Python."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import token_groups
from millrace.llm.components import components
from millrace.llm.sentence_spans import Spans, drop_repeated
from millrace.llm.shared import written
from millrace.llm.shingles import _BLOCK, mixed, runs, shingle_sets, word_hashes
from millrace.llm.token_groups import Similarity, _blocks_of, _class, _mark, block_keys, drop_near_copies, jaccard_groups, parity_marks
from samples import prose  # noqa: I001

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles_of(text, n):
    w = words_of(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def expected_components(rows, how):
    """(id, n) -> smallest id reachable, with rows as nodes."""
    sets = [shingles_of(t, how.n) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and how.den * common >= how.num * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)].append(d)
    return sorted(
        ((d, len(s), (min(least[root(i)], default=None) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str
    )


@pytest.mark.parametrize("how", [Similarity(), Similarity(3, 90, 100), Similarity(1, 5, 10)])
def test_groups(corpus, odd_docs, no_docs, how):
    got = sorted((tuple(r) for r in jaccard_groups(odd_docs, how).collect()), key=str)
    assert got == expected_components([(i, t) for i, t, *_ in corpus], how)
    if how.n == 5:
        assert jaccard_groups(no_docs, how).count() == 0
        kept = drop_near_copies(odd_docs, how)
        assert kept.columns == odd_docs.columns
        assert kept.filter("doc_id between 100 and 111").count() == 0 and kept.filter("doc_id = 3").count() == 1
        assert kept.filter("doc_id is null").count() == 2


def test_chains_of_near_copies(spark):
    """Copies of copies: the ends of a chain are linked through its middle only; families overlap in passages."""
    rng = random.Random(5)
    rows, i = [], 0
    for family in range(6):
        w = prose(rng, 90).split()
        shared = prose(rng, 60).split()
        for step in range(14):
            w = list(w)
            w[rng.randrange(len(w))] = prose(rng, 1)
            if step % 5 == 4:
                w += shared[: 6 * family]
            rows.append((i, " ".join(w)))
            i += 1
    how = Similarity(3, 85, 100)
    got = sorted((tuple(r) for r in jaccard_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), how).collect()), key=str)
    assert got == expected_components(rows, how)


@pytest.mark.parametrize("num,den", [(8, 10), (90, 100), (6, 10)])
def test_linked_sets_share_a_block(num, den):
    """Whatever two sets differ in, within what a link allows, a block is common."""
    rng, how = np.random.default_rng(1), Similarity(5, num, den)
    for _ in range(400):
        n = int(rng.integers(2, 300))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        cut = int(rng.integers(0, max(1, (den - num) * len(a) // den) + 1))
        grown = np.unique(np.concatenate([a[cut:], rng.integers(0, 1 << 62, int(rng.integers(0, len(a) // 3 + 1))).astype(np.uint64)]))
        common = len(np.intersect1d(a, grown))
        if not common or np.array_equal(a, grown) or den * common < num * (len(a) + len(grown) - common):
            continue
        keys, need = [{0: set(), 1: set()} for _ in (0, 1)], [{}, {}]
        for up, owner, key, _, least in block_keys([a, grown], how):
            for side in (0, 1):
                keys[side][up] |= set(key[owner == side].tolist())
                need[side].update({up: int(x) for x in least[owner == side]})
        shared = {(x, y): len(keys[0][x] & keys[1][y]) for x in (0, 1) for y in (0, 1)}
        # One class holds the pair, and both sets have the blocks there that they need.
        assert any(n and n >= need[0][x] and n >= need[1][y] for (x, y), n in shared.items())


def test_size_class(spark):
    from pyspark.sql import functions as F

    got = spark.range(1, 5000).filter(_class(F.col("id")) != F.floor(F.log2("id") + 1e-12)).count()
    assert got == 0


@pytest.mark.parametrize("n", [1, 3, 5])
def test_shingle_counts(corpus, n):
    texts = [t for _, t, *_ in corpus]
    assert [len(s) for s in shingle_sets(pa.array(texts), n)] == [len(shingles_of(t, n)) for t in texts]
    sliced = pa.array(texts).slice(20, 30)
    assert [len(s) for s in shingle_sets(sliced, n)] == [len(shingles_of(t, n)) for t in texts[20:50]]


def test_hashes_across_blocks():
    """Words hash alike wherever they stand, also behind the end of a block and longer than one."""
    long = "x" * (_BLOCK + 10)
    text = ("alpha beta " * (_BLOCK // 8) + long + " alpha " + long + "y alpha").encode()
    h = word_hashes(np.frombuffer(text, dtype=np.uint8))
    assert len(h) == len(text.split()) and len(set(h[:-5].tolist())) == 2
    assert h[-1] == h[0] == h[-3] and h[-2] != h[-4] and len(runs(h[:0], 3)) == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def expected_spans(rows, how, longest=30):
    """Texts without repeated spans, by position of the row: every run of up to ``longest`` sentences is looked at."""
    cuts, seen = [], defaultdict(list)
    for n, (d, t) in enumerate(rows):
        found = [(m.start(), m[0].translate(LOWER)) for m in re.finditer(r"[^\x20\x09-\x0D]+", t or "")]
        ends = [i for i, (at, w) in enumerate(found) if w[-1] in ".!?;:," or i + 1 == len(found) or "\n" in t[at : found[i + 1][0]]]
        begins = [0, *[e + 1 for e in ends[:-1]]] if found else []
        cuts.append((found, begins))
        for s in range(len(begins)):
            for e in range(s + how.sentences - 1, min(len(ends), s + longest)):
                if ends[e] - begins[s] + 1 >= how.words:
                    seen[hash(tuple(w for _, w in found[begins[s] : ends[e] + 1]))].append(((d is not None, d or 0), n, s, e))
    gone = defaultdict(set)
    for places in seen.values():
        for _, n, s, e in sorted(places)[1:]:
            gone[n].update(range(s, e + 1))
    out = []
    for n, ((d, t), (found, begins)) in enumerate(zip(rows, cuts)):
        edges = [found[b][0] for b in begins] + [len(t or "")]
        text = (t or "")[: edges[0]] + "".join((t or "")[edges[k] : edges[k + 1]] for k in range(len(begins)) if k not in gone[n])
        out.append((d, text, len(begins), len(gone[n])))
    return sorted(out, key=str)


def test_repeated_spans(spark, corpus, odd_docs, no_docs):
    """All runs of sentences against brute force; rows in one partition, so that those of one id have an order."""
    rng = random.Random(6)
    shared = [sized(rng, 15, 15, 3), sized(rng, 3, 9, 9, 2), sized(rng, 11, 12)]
    rows = [(i, t) for i, t, *_ in corpus]
    rows += [(900 + i, f"{sized(rng, 4, 9)} {shared[i % 3]} {sized(rng, 7)} {shared[(i + 1) % 3]}") for i in range(9)] + [(900, shared[0]), (None, shared[1])] * 2
    whole = Spans(long=10**9)  # no sentence is cut into pieces
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = sorted(((r.doc_id, r.text, r.n_sentences, r.n_removed) for r in drop_repeated(df, whole).collect()), key=str)
    assert got == expected_spans(rows, whole)
    assert drop_repeated(no_docs).count() == 0
    assert drop_repeated(odd_docs).columns == ["doc_id", "text", "n_sentences", "n_removed", "removed_words"]
    assert drop_repeated(odd_docs).count() == len(corpus)


def test_rows_of_one_id_and_of_none(spark):
    """Copies under one id or under none are documents of their own: one of them keeps the text."""
    rng = random.Random(7)
    text = sized(rng, 12, 12, 12)
    rows = [(5, text)] * 3 + [(None, text)] * 2
    got = [(r.doc_id, r.text) for r in drop_repeated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    assert sorted(got, key=str) == sorted([(None, text), (None, ""), (5, ""), (5, ""), (5, "")], key=str)


def test_passage_inside_other_texts(spark):
    rng = random.Random(9)
    passage = prose(rng, 60)
    rows = [(i, prose(rng, 50)[:-5] + (" " + passage + " " if i % 2 else " ") + prose(rng, 50)) for i in range(8)]
    got = {r.doc_id: r for r in drop_repeated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    texts = dict(rows)
    assert all(got[i].text == texts[i] and not got[i].n_removed for i in (0, 1, 2, 4, 6))
    assert all(got[i].removed_words >= 40 and passage[150:350] not in got[i].text for i in (3, 5, 7))


def sized(rng, *sizes):
    """Sentences of so many words each, with no word twice."""
    return " ".join(" ".join(f"w{rng.randrange(10**9)}" for _ in range(n)) + "." for n in sizes)


@pytest.mark.parametrize("passage", [
    lambda rng: sized(rng, 15, 15, 3), lambda rng: sized(rng, 3, 15, 15, 3, 2), lambda rng: sized(rng, 24),
    lambda rng: sized(rng, 12, 12).replace(".", "。"), lambda rng: sized(rng, 12, 12).replace(".", "؟"),
])
def test_whole_passage_goes(spark, passage):
    """Also its short last sentences, one long sentence, and sentences with ends of other scripts."""
    rng = random.Random(4)
    repeated = passage(rng)
    rows = [(i, f"{sized(rng, 8)} {repeated} {sized(rng, 8)}") for i in (1, 2)]
    got = {r.doc_id: r.text for r in drop_repeated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: rows[0][1], 2: rows[1][1].replace(repeated + " ", "")}


def test_passage_without_marks(spark):
    rng = random.Random(8)
    repeated = sized(rng, 90)[:-1]
    rows = [(i, f"{sized(rng, 30)[:-1]} {repeated} {sized(rng, 30)}") for i in (1, 2)]
    got = {r.doc_id: r for r in drop_repeated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1].text == rows[0][1] and got[2].removed_words >= 40
    assert set(rows[1][1].split()) - set(repeated.split()) <= set(got[2].text.split())


def test_links_beside_a_centre_that_has_no_place(spark):
    """Two sets meet only in blocks whose central sets, hubs of large families, hold tokens of one of the two."""
    how, rng = Similarity(1, 8, 10), random.Random(12)
    k = int(_blocks_of(np.array([128 * 0.7]), how.most_different(np.array([127]), np.array([127])))[0])

    def words(n, fits=lambda block: True):
        out = []
        while len(out) < n:
            w = f"t{rng.randrange(10**12)}"
            token = runs(word_hashes(np.frombuffer(w.encode(), dtype=np.uint8)), 1)
            if fits(int(mixed(token ^ np.uint64(0xA5A5A5A5DEADBEEF))[0] % np.uint64(k))):
                out.append(w)
        return out

    rows = []
    for family in range(4):
        stem = {b: words(3, lambda x, b=b: x == b) for b in range(k)}
        shared = [w for ws in stem.values() for w in ws]
        p, q = words(9), words(9)
        rows += [" ".join(shared + p), " ".join(shared + q)]
        for low in range(0, k, 5):
            part = range(low, min(k, low + 5))
            hub = [w for b in part for w in stem[b]] + p + words(75, lambda x: x not in part)
            rows += [" ".join(hub)] + [" ".join(hub[:-1] + words(1, lambda x: x not in part)) for _ in range(12)]
    rows = list(enumerate(rows))
    got = sorted((tuple(r) for r in jaccard_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), how).collect()), key=str)
    assert got == expected_components(rows, how)


def test_near_copies_with_repeated_and_null_ids(spark):
    rng = random.Random(21)
    a, b, c, d, e, f = (sized(rng, 60) for _ in range(6))
    near = lambda t: t + " more"
    rows = [
        (3, a), (7, near(a)), (7, b), (7, None),  # one row of 7 goes, the others stay
        (1, c), (1, near(c)), (1, c + "  "), (8, near(c) + " y"),  # one row of 1 stays
        (None, d), (None, near(d)), (4, d), (None, None), (None, ""), (None, e),  # one row without an id stays
        (9, f), (10, near(f)), (10, f),  # all rows of 10 go
    ]
    docs = spark.createDataFrame([(t, i, {"k": "v"}) for i, t in rows], "text string, doc_id bigint, m map<string,string>")
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    for i, texts in ((3, [a]), (8, []), (4, []), (9, [f]), (10, [])):
        assert [t for x, t in got if x == i] == texts
    assert sorted(t or "" for x, t in got if x == 7) == ["", b]
    assert len([t for x, t in got if x == 1]) == 1
    without = [t for x, t in got if x is None]
    assert len(without) == 4 and without.count(None) == without.count("") == without.count(e) == 1


def test_marks_differ_in_no_more_bits_than_sets_in_tokens(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(2)
    for size, other in ((0, 3), (1, 1), (40, 30), (400, 500)):
        a, b = (rng.integers(0, 1 << 64, n, dtype=np.uint64) for n in (size, other))
        b = np.unique(np.concatenate([a[: size // 2], b]))
        bits = sum(int(x).bit_count() for x in (parity_marks(a) ^ parity_marks(b)).view("<u8"))
        assert bits <= len(np.setxor1d(a, b)) and not (parity_marks(a) ^ parity_marks(a)).any()
    tokens = [int(x) for x in rng.integers(-(1 << 63), 1 << 63, 300)] + [63, 64, -1, 255]
    words = [_mark(F.col("t"), i) for i in range(token_groups.MARK_WORDS)]
    for r in spark.createDataFrame([(t,) for t in tokens], "t bigint").select("t", *words).collect():
        assert list(r[1:]) == parity_marks(np.array([r.t], dtype=np.int64).view(np.uint64)).tolist()


def test_copies_with_many_changes_are_not_all_paired(spark, monkeypatch):
    """Members of a family have changed the same places to the same words, so that hardly a token is held alone."""
    rng, how, asked = random.Random(31), Similarity(1, 8, 10), []
    base, pool = [f"b{i}" for i in range(120)], [f"p{i}" for i in range(60)]
    rows = []
    for i in range(120):
        w = list(base)
        for at, new in zip(rng.sample(range(120), 15 if i % 3 == 0 else 5), rng.sample(pool, 15)):
            w[at] = new
        rows.append((i, " ".join(w)))
    real = token_groups._linked
    monkeypatch.setattr(token_groups, "_linked", lambda pairs, *rest: asked.append(pairs.count()) or real(pairs, *rest))
    got = sorted(tuple(r) for r in jaccard_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), how).collect())
    assert got == sorted(expected_components(rows, how))
    assert len({c for *_, c in got}) > 20 and len(asked) == 2 and asked[1] < 400


def test_written_leaves_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split()
        return {f for f in found if "shuffle_" in f}

    before, table = files(), written(spark.range(5000).selectExpr("id % 700 AS k").groupBy("k").count())
    assert not files() - before and table.count() == 700
