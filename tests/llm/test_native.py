"""Operators of DataFrame functions against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import chunk_dedup
from millrace.llm.chunk_dedup import drop_copies, duplicates
from millrace.llm.host_rules import Limits, host_verdicts, keep_good, with_counts, with_failures
from millrace.llm.personal_data import KINDS, find_personal_data, mod_97, redact, spans_text
from millrace.llm.source_mix import MOST_COPIES, mix, mixed_rows, targets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def python_nodes(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"\w*(?:Python|Pandas|Arrow)\w*", plan)


def expected_groups(corpus):
    groups = defaultdict(list)
    for i, t, *_ in corpus:
        groups[(t or "").translate(LOWER)].append(i)
    return groups


def test_duplicates(corpus, odd_docs):
    found = duplicates(odd_docs)
    assert not python_nodes(found)
    rows = found.select("doc_id", "keep_id", "group_size", found["kept"], "text_sha256").collect()
    want = Counter()
    for text, ids in expected_groups(corpus).items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[(i, keep, len(ids), i == keep, hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())] += 1
    assert Counter(tuple(r) for r in rows) == want


def test_different_chunks_under_one_identifier(spark, monkeypatch):
    """Texts stay apart when all their chunks get one identifier."""
    real = chunk_dedup.with_recipe

    def clash(docs, text="text", prefix=""):
        return real(docs, text, prefix).withColumn(
            f"{prefix}recipe", F.transform(f"{prefix}recipe", lambda c: F.struct(F.lit(1).alias("n"), F.lit(1).cast("long").alias("h")))
        )

    monkeypatch.setattr(chunk_dedup, "with_recipe", clash)
    rows = spark.createDataFrame([(1, "aaa"), (2, "bbb"), (3, "AAA")], "doc_id bigint, text string")
    assert {(r.doc_id, r.keep_id) for r in chunk_dedup.duplicates(rows).collect()} == {(1, 3), (2, 2), (3, 3)}


def test_chunks_rebuild_their_text(docs):
    texts = docs.withColumn("t", F.repeat(F.coalesce("text", F.lit("")), 9))
    assert texts.filter(F.concat_ws("", chunk_dedup.chunks(F.col("t"))) != F.col("t")).count() == 0


def test_drop_copies(corpus, odd_docs, no_docs):
    kept = drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = [(r.doc_id, (r.text or "").translate(LOWER)) for r in kept.collect()]
    groups = expected_groups(corpus)
    want = {(max((i for i in ids if i is not None), default=None), t) for t, ids in groups.items()}
    assert len(rows) == len(groups) and set(rows) == want
    assert drop_copies(no_docs).count() == 0 and duplicates(no_docs).count() == 0


def expected_counts(text):
    t = text or ""
    w = words_of(t)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in t.split("\n") if words_of(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_counts(corpus, odd_docs, no_docs):
    found = with_counts(odd_docs)
    assert not python_nodes(found)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found.collect())
    assert got == Counter((i, *expected_counts(t)) for i, t, *_ in corpus)
    assert with_counts(no_docs).count() == 0


@pytest.mark.parametrize("text", ["a b " * 40, "x" * 70_000, "a | b # c\n" * 25, "\n\n\na\n\na\n", "w " * 8, "w " * 9])
def test_counts_of_odd_texts(spark, text):
    rows = with_counts(spark.createDataFrame([(text,)], "text string")).first()
    assert tuple(rows)[1:] == expected_counts(text)


def test_host_verdicts(spark):
    """A bad host loses its documents that fail a soft rule, and only those."""
    rows = [(i, "bad", i < 18, i < 9) for i in range(20)] + [(100 + i, "good", i < 2, False) for i in range(40)] + [(200, None, True, False)]
    rated = spark.createDataFrame(rows, "doc_id bigint, host string, rule_failed boolean, base_failed boolean")
    got = {r.doc_id: r.kept for r in host_verdicts(rated, "host", Limits(prior_strength=(1, 5))).collect()}
    assert got == {i: not (h == "bad" and f) and not b or (h != "bad" and not b) if h is not None else got[i] for i, h, f, b in rows}
    assert not got[10] and got[19] and got[101]


def test_keep_good(odd_docs, no_docs, corpus):
    kept = keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    counts = [expected_counts(t) for _, t, *_ in corpus]
    assert kept.count() == sum(c[0] >= 20 and 100 * c[4] <= 30 * c[0] for c in counts)
    assert keep_good(no_docs).count() == 0


def expected_targets(sizes, weights=(5, 2, 1)):
    """Shares again and again until no target is above three times its size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = left / sum(w[s] for s in open_)
        over = {s for s in open_ if share * w[s] > 3 * sizes[s]}
        if not over:
            target.update({s: share * w[s] for s in open_})
            break
        target.update({s: 3.0 * sizes[s] for s in over})
        left -= sum(3.0 * sizes[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 50, None: 7, "": 300}, {"a": 0}, {"b": 5, "a": 0, "c": 1}, {f"s{i}": i * i for i in range(30)}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in targets(rows).collect()}
    assert got == pytest.approx(expected_targets(sizes))


def test_mix(corpus, odd_docs, no_docs):
    found = mix(odd_docs, prefix="m_")
    assert not python_nodes(found)
    rows = found.collect()
    sizes = Counter()
    for _, t, _, s, _ in corpus:
        sizes[s] += len(words_of(t))
    want = expected_targets(sizes)
    taken, largest = Counter(), Counter()
    for r in rows:
        assert r.m_size == len(words_of(r.text)) and r.m_target == pytest.approx(want[r.source])
        assert r.m_taken == r.m_copies * r.m_size <= MOST_COPIES * r.m_size
        taken[r.source] += r.m_taken
        largest[r.source] = max(largest[r.source], r.m_size)
    assert len(rows) == len(corpus)
    assert all(abs(taken[s] - want[s]) <= 2 * largest[s] for s in want)
    again = {(r.doc_id, r.text): r.m_copies for r in mix(odd_docs.repartition(7), prefix="m_").collect()}
    assert all(again[r.doc_id, r.text] == r.m_copies for r in rows)
    copies = mixed_rows(odd_docs)
    assert copies.columns == odd_docs.columns and copies.count() == sum(r.m_copies for r in rows)
    assert mix(no_docs).count() == 0 and mixed_rows(no_docs).count() == 0


def expected_copies(docs, target, most=3):
    """Expected copies of documents (size, weight) of one source: rate times weight, at most ``most``."""
    limited = set()
    while True:
        left = target - sum(most * s for i, (s, _) in enumerate(docs) if i in limited)
        total = sum(s * w for i, (s, w) in enumerate(docs) if i not in limited)
        rate = left / total if total else 0.0
        over = {i for i, (_, w) in enumerate(docs) if i not in limited and rate * w > most}
        if not over:
            return [most if i in limited else rate * w for i, (_, w) in enumerate(docs)]
        # The heaviest reach the limit first.
        top = max(docs[i][1] for i in over)
        limited |= {i for i, (_, w) in enumerate(docs) if w == top}


@pytest.mark.parametrize("kinds", [None, [0.0, 1.0, 2.5, 40.0], [1.0], [0.0]])
def test_mix_by_document_weights(spark, corpus, kinds):
    """Certain copies and Pareto order against plain Python, with document-wise odds."""
    rows = [(i, t, s) for i, t, _, s, _ in corpus if i is not None and i != 5]
    weights = [None if kinds is None else kinds[i % len(kinds)] for i, _, _ in rows]
    df = spark.createDataFrame([(*r, w) for r, w in zip(rows, weights)], "doc_id bigint, text string, source string, w double")
    got = {r.doc_id: r for r in mix(df, document_weight=None if kinds is None else F.col("w")).collect()}
    sizes = [len(words_of(t)) for _, t, _ in rows]
    total = Counter()
    for (_, _, s), n in zip(rows, sizes):
        total[s] += n
    want = expected_targets(total)
    for source in total:
        mine = [k for k, r in enumerate(rows) if r[2] == source]
        w = [(2 if sizes[k] >= 20 else 1) if kinds is None else weights[k] for k in mine]
        expected = expected_copies([(sizes[k], x) for k, x in zip(mine, w)], want[source])
        need = want[source] - sum(int(e + 1e-12) * sizes[k] for k, e in zip(mine, expected))
        ranks = {}
        for k, e in zip(mine, expected):
            chance = e - int(e + 1e-12)
            if chance > 1e-9:
                i, t, _ = rows[k]
                u = int(hashlib.md5(f"mix:{i}:{hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest()[:12], 16)
                x = (u + 0.5) / 2**48
                ranks[k] = x / (1 - x) / (chance / (1 - chance))
        upto, best, taken = 0, (abs(need), 0), sorted(ranks, key=ranks.get)
        for n, k in enumerate(taken, 1):
            upto += sizes[k]
            best = min(best, (abs(need - upto), n))
        sampled = set(taken[: best[1]])
        for k, e in zip(mine, expected):
            # Documents of size 0 at the very cut may go either way.
            if sizes[k]:
                assert got[rows[k][0]].copies == int(e + 1e-12) + (k in sampled), (source, rows[k][0])


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def passes_luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(x) < 256 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and passes_luhn(d), "phone": 10 <= len(d) <= 15}
            if good[kind]:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for *_, x in sorted(out))


PII = [
    "write to a.b+c@mail.example.com_d@e.fg or x@y or @z.com, q@w..r.t@u.v",
    "hosts 1.2.3.4.5.6.7.8 and 300.1.1.1 007.08.0255.1 1.2.3 999.1.2.3.4",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 and 4111111111111111 2222 4929348385146306",
    "call +1 (487) 555-7209 or +49 30 (0) 12345678 -- +1 2 +",
    "é😀 a@b.co é😀 +1 (487) 555-7209", None, "", "@", "+", "1", "a" * 50_000 + "@", "1" * 60_000, "1 " * 30_000, "1." * 30_000, "+1" + " " * 40_000,
    "a@" * 5_000, "a@b.cd " * 300,
]


def test_base_spans(spark):
    rows = spark.createDataFrame(list(enumerate(PII)), "doc_id int, text string")
    found = find_personal_data(rows)
    assert not python_nodes(found)
    got = {r.doc_id: r.s for r in found.select("doc_id", spans_text(F.filter("found", lambda s: s["base"])).alias("s")).collect()}
    assert got == {i: base_spans(t) for i, t in enumerate(PII)}


def test_check_sums_and_context(spark):
    texts = ["Konto DE89 3704 0044 0532 0130 00 ok", "DE89 3704 0044 0532 0130 01 no", "my SSN 123-45-6789", "part 123-45-6789", "ssn 000-45-6789"]
    rows = find_personal_data(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert [[(s.kind, s.start, s.end) for s in r.found if s.kind in ("iban", "social")] for r in rows] == [[("iban", 6, 33)], [], [("social", 7, 18)], [], []]
    good = spark.createDataFrame([("GB82WEST12345698765432", True), ("GB82WEST12345698765433", False)], "a string, ok boolean")
    assert good.filter(mod_97(F.col("a")) != F.col("ok")).count() == 0
    assert {k.name for k in KINDS if k.base} == {k for k, _ in BASE}


def test_redact(spark, odd_docs, no_docs):
    rows = spark.createDataFrame([("to a@b.co, +1 (487) 555-7209.",), ("none",), (None,)], "text string")
    assert [r.text for r in redact(rows).collect()] == ["to [email], [phone].", "none", None]
    assert redact(odd_docs).columns == odd_docs.columns and find_personal_data(no_docs).count() == 0


def test_account_numbers_before_other_words(spark):
    texts = [
        "DE89 3704 0044 0532 0130 00 Please pay", "DE89370400440532013000 12 May", "DE89370400440532013000 OK", "see AB12 DE89370400440532013000",
        "DE89370400440532013000 GB82WEST12345698765432", "DE89370400440532013000X", "NO12 GB82 WEST 1234 5698 7654 32 A", "DE89370400440532013001 OK",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = find_personal_data(df).orderBy("i").collect()
    got = [[(s.start, s.end) for s in r.found if s.kind == "iban"] for r in rows]
    assert got == [[(0, 27)], [(0, 22)], [(0, 22)], [(9, 31)], [(0, 22), (23, 45)], [], [(5, 32)], []]
    assert redact(df).filter("i = 1").first().text == "[iban] 12 May"


def test_tables_of_copies_hold_no_texts(spark, docs, monkeypatch):
    """Only ids, recipes and hashes are written on the way; the texts are read from where they are."""
    tables, real = [], chunk_dedup.written
    monkeypatch.setattr(chunk_dedup, "written", lambda df: tables.append(df.columns) or real(df))
    assert chunk_dedup.drop_copies(docs).columns == docs.columns
    assert len(tables) == 3 and not any("text" in t for t in tables)


def test_texts_are_cut_into_chunks_once(spark, monkeypatch):
    """One of the written tables is made from the texts, the others from it; no text or chunk is shuffled."""
    plans, real = [], chunk_dedup.written
    monkeypatch.setattr(chunk_dedup, "written", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    result = chunk_dedup.duplicates(spark.createDataFrame([(1, "a"), (2, "A")], "doc_id bigint, text string"), with_text=False)
    plans.append(result._jdf.queryExecution().executedPlan().toString())
    cut = [p for p in plans if "regexp_extract_all" in p]
    assert len(cut) == 1 and "Exchange" not in cut[0]
