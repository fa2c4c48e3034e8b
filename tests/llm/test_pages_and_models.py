"""Pages, packing, the quality network and the secret forest."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import prose  # noqa: I001
from millrace.llm.packing import LENGTH, SHARD_DOCS, best_fit, cut_points, local_search, pack, pack_documents
from millrace.llm.page_text import blocks, extract_pages, main_text, min_cut
from millrace.llm.quality_net import Network, fit, quality_scores
from millrace.llm.secret_forest import CANDIDATE, Forest, find_secrets
from millrace.llm.token_ids import tokenizer_file

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="<p>no</p>";</script></head><body>
<header><a href="/">Home</a><p>Site of things.</p></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site, as everybody does.</div><!-- <p>hidden</p> --><aside class="sidebar"><p>Read this too, it is good.</p></aside>
{body}<section id="comments"><p>Great article, I liked all of it.</p></section><form><label>Mail</label><input name="m"><button>Send</button></form>
<footer>&copy; 2020 &middot; all rights</footer></body></html>"""


@pytest.mark.parametrize(
    "body,want",
    [
        ("<article><h1>Title &amp; more</h1><p>First  line\nof\ttext.</p><p>x</p></article>", "Title & more\nFirst line of text.\nx"),
        ("<article><h1>A</h1><p><b>Broken<br><p>Second <i>par</i>t.</p><p><b>Third.<br></article>", "A\nBroken\nSecond part.\nThird."),
        ("<article><p>One.</p><div class='ad'>Buy now, only today.</div><p>Two.</p><p hidden>No.</p></article>", "One.\nTwo."),
        ("<main><ul><li>first point of it<li>second point of it</ul></main>", "first point of it\nsecond point of it"),
        ("<article><p>5 &lt; 6 &#x41; &eacute; &am &nbsp;end</p></article>", "5 < 6 A é &am end"),
        ("", ""),
    ],
)
def test_main_text(body, want):
    assert main_text(PAGE.format(body=body)) == want


def test_page_without_semantic_tags():
    text = "A long paragraph that tells a story in many words and ends with a stop. " * 4
    html = f"<div id=menu><a href=a>Start</a> <a href=b>News</a></div><div><p>{text}</p><p>{text}</p><p>Short.</p></div><div class=footer>Imprint</div>"
    assert main_text(html) == "\n".join([text.strip(), text.strip(), "Short."])


FRAMES = [
    ('<body class="single has-sidebar"><article>', "</article>"),
    ('<body class="post-template-default single single-post postid-7 no-sidebar comments-open"><article>', "</article>"),
    ('<body class="home page-with-sidebar"><main class="site-main no-menu">', "</main>"),
    ('<div class="content-with-sidebar">', "</div>"),
    ('<div class="content sidebar-left">', "</div>"),
    ('<div id="wrapper" class="has-header with-footer"><div class="content-area">', "</div></div>"),
    ('<article class="post comment-status-open">', "</article>"),
    ('<article id="post-9" class="post-9 post type-post status-publish hentry category-social tag-newsletter tag-ads">', "</article>"),
    ('<article class="entry has-post-thumbnail sharing-enabled"><div class="entry-content">', "</div></article>"),
    ('<div class="layout-sidebar-right"><div role="main">', "</div></div>"),
    ('<section class="story theme-header-dark"><div class="story-body">', "</div></section>"),
    ('<div class="menu-open page"><div class="post-content">', "</div></div>"),
    ('<div class="overlay"><main>', "</main></div>"),
    ('<div class="col-nav no-toolbar"><h1>Title</h1><div class="text">', "</div></div>"),
]


@pytest.mark.parametrize("begin,end", FRAMES)
def test_names_of_frames_are_no_evidence(begin, end):
    """Theme classes about a sidebar, comments or a menu elsewhere leave the page's text alone, and its parts are still left out."""
    story = "The harbour was quiet when the two boats came in from the north, one behind the other."
    got = main_text(PAGE.format(body=f"{begin}<p>{story}</p><p>{story}</p>{end}"))
    assert [t for t in got.split("\n") if t != "Title"] == [story, story]


@pytest.mark.parametrize("frame", ['<form id="aspnetForm" method="post">{}</form>', '<div class="modal-page overlay">{}</div>', '<form>{}</form>'])
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<h1>Title</h1><div>{}</div>", "<div id=content>{}</div>", "<div>{}</div>"])
def test_frame_around_the_whole_page(frame, inner):
    story = "<p>The harbour was quiet when the two boats came in from the north, one behind the other.</p>" * 3
    menu, foot = "<nav><a href=/a>One</a> <a href=/b>Two</a></nav>", "<footer>All rights reserved</footer>"
    got = main_text("<body>" + frame.format(menu + inner.format(story) + foot) + "</body>")
    assert [t for t in got.split("\n") if t != "Title"] == ["The harbour was quiet when the two boats came in from the north, one behind the other."] * 3


def test_comments_stay_out_however_long_they_are():
    story = "The harbour was quiet when the two boats came in from the north, one behind the other."
    talk = "".join(f'<article class="comment even depth-1"><p>I have been there too and it was lovely, number {i}, thank you.</p></article>' for i in range(40))
    assert main_text(f'<body><article><p>{story}</p></article><div class="comments-area"><h1>Comments</h1>{talk}</div></body>') == story


@pytest.mark.parametrize("html", ["", None, "<", "<p", "<p>a<!-- b", "plain", "</p></div>", "<script>x", "<a <b>c", "<p>" * 3000, "x" * 200_000, "<div>" * 500 + "t" + "</div>" * 500])
def test_odd_pages(html):
    main_text(html)


def test_block_structure():
    found = blocks("a<p>b <b>c</b>d<br>e<td>f</p>g<![CDATA[<x>]]>")
    assert [b.text for b in found] == ["a", "b cd e", "f", "g<x>"]


@pytest.mark.parametrize("start", [
    "<script>for(i=0;i<n;i++){x()}</script>", "<script>if(a<b)c='</p>'</script >", "<style>a<b{}</style>", "<title>a<b</title>",
    "<textarea>if a<b</textarea>", "<select><option>o</select>", "<svg><title>t</title><svg><p/></svg></svg>",
    "<svg><foreignObject><div>no</div></foreignObject></svg>", "<object><object></object>no</object>", "<video><p>no</p></video>",
    "<iframe src=x>", "<svg><path d=x>", "<math><mi>", "<div><select><option></div>", "<p><object><video></p>", "<template>", "<title>", "<audio><video><object>",
])
def test_text_behind_elements_without_text(start):
    """What stands behind them is there, whether they have signs of markup in them or are left open."""
    for html in (f"<p>one</p>{start}<p>two</p><p>three</p>", f"<p>one</p>{start}<p>two</p>{start}<p>three</p>"):
        assert [t for b in blocks(html) if (t := b.text)] == ["one", "two", "three"]
    assert [b.text for b in blocks(f"<p>one</p><p>two {start}")if b.text] == ["one", "two"]


def test_many_open_elements_take_linear_time():
    assert [b.text for b in blocks("<svg>" * 3000 + "<object>" * 3000 + "</object>end") if b.text] == ["end"]


def cut_value(side, scores, edges):
    return sum(s for s, x in zip(scores, side) if s > 0 and not x) + sum(-s for s, x in zip(scores, side) if s < 0 and x) + sum(
        w for (i, j), w in edges.items() if side[i] != side[j]
    )


def test_min_cut_is_least():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 9)
        scores = [rng.choice([-1, 1]) * rng.random() * 2 for _ in range(n)]
        edges = {(i, j): rng.random() for i in range(n) for j in range(i + 1, n) if rng.random() < 0.6}
        least = min(cut_value([m >> i & 1 for i in range(n)], scores, edges) for m in range(1 << n))
        assert cut_value(min_cut(scores, edges), scores, edges) == pytest.approx(least)


def test_extract_pages(spark):
    rows = [(1, "u", PAGE.format(body="<article><p>Text é here.</p></article>"), "x"), (2, None, None, None), (None, "v", "", "y"), (1, "u", "<p>A b.</p>", "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars string")
    got = sorted((tuple(r) for r in extract_pages(pages).select("page_id", "url", "text", "n_chars").collect()), key=str)
    assert got == sorted([(1, "u", "Text é here.", 12), (2, None, "", 0), (None, "v", "", 0), (1, "u", main_text("<p>A b.</p>"), len(main_text("<p>A b.</p>")))], key=str)
    assert extract_pages(pages.limit(0)).count() == 0


def reference_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file())
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def test_packing(corpus, odd_docs, no_docs):
    rows = pack_documents(odd_docs, tokenizer_file()).collect()
    want = defaultdict(int)
    for (i, *_), ids in zip(corpus, reference_ids([t for _, t, *_ in corpus])):
        first = len(ids) % LENGTH or LENGTH
        spans = [(0, min(first, len(ids))), *[(s, LENGTH) for s in range(first, len(ids), LENGTH)]]
        for k, (s, n) in enumerate(spans):
            want[(i, k, s, n, zlib.crc32(np.array(ids[s : s + n], dtype="<u4").tobytes()))] += 1
    got, sequences = defaultdict(int), defaultdict(list)
    for r in rows:
        got[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= LENGTH
    assert len(sequences) <= -(-sum(k[3] * c for k, c in want.items()) // LENGTH) + 1
    assert pack_documents(no_docs, tokenizer_file()).count() == 0


def test_rows_that_repeat_spread_over_shards(spark):
    """Forty thousand equal rows without an id: no shard gets more than its share."""
    rows = spark.range(0, 40_000, 1, 5).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "0 AS piece", "0L AS start", "1L AS length", "9L AS ids_crc32")
    packed = pack(rows, -(-40_000 // SHARD_DOCS))
    sizes = [r["count"] for r in packed.groupBy(F.col("sequence_id") % 3).count().collect()]
    assert len(sizes) == 3 and max(sizes) < SHARD_DOCS and packed.select("sequence_id").distinct().count() <= 42


def test_cut_points():
    assert cut_points(5, 10) == [(0, 5)] and cut_points(10, 10) == [(0, 10)] and cut_points(23, 10) == [(0, 3), (3, 10), (13, 10)]


def test_local_search_empties_bins():
    """Best fit leaves one bin more than needed; a two-for-one exchange frees it."""
    sizes = np.array([6, 5, 5, 4, 4, 3, 3])
    bins = [[0, 5], [1, 3], [2, 4], [6]]  # fills 9, 9, 9, 3 of 10
    got = local_search([list(b) for b in bins], sizes, 10)
    assert len(got) == 3 and sorted(i for b in got for i in b) == list(range(7)) and all(sizes[b].sum() <= 10 for b in got)
    rng = np.random.default_rng(4)
    for _ in range(20):
        sizes = rng.integers(1, 100, 200)
        start = best_fit(sizes, 100)
        got = local_search([list(b) for b in start], sizes, 100)
        assert len(got) <= len(start) and sorted(i for b in got for i in b) == list(range(200)) and all(sizes[b].sum() <= 100 for b in got)


def labelled_docs(spark, n=900):
    rng = random.Random(8)
    texts = []
    for i in range(n):
        good = rng.random() < 0.8
        t = prose(rng, rng.randint(20, 80))
        if not good:
            t = rng.choice([t.replace(" ", " | "), t.replace(" ", "### "), " ".join(w for x in t.split()[:8] for w in [x] * 9), t.upper().replace(" ", "!! ")])
        texts.append((i, t, int(good)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts] + [(n, None), (n + 1, ""), (None, "a b c"), (3, texts[3][1])], "doc_id bigint, text string")
    return docs, spark.createDataFrame([(i, q) for i, _, q in texts] + [(n, None), (3, 0)], "doc_id bigint, quality int")


def test_quality_scores(spark):
    docs, labels = labelled_docs(spark)
    got = quality_scores(docs.withColumn("score", F.lit("x")), labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in docs.filter("doc_id is not null").collect()}
    some = got[got.doc_id.notna()]
    assert all(h == held[int(i)] for i, h in zip(some.doc_id, some.held_out)) and (got.predicted == (got.score >= 0.3)).all()
    both = got[got.held_out].merge(labels.filter("doc_id <> 3").toPandas(), on="doc_id").dropna()
    assert len(both) > 100 and (both.predicted == both.quality).mean() > 0.9


def test_held_out_labels_change_nothing(spark):
    docs, labels = labelled_docs(spark, 200)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    turned = labels.withColumn("quality", F.when(fold == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality_scores(docs, x, Network(epochs=2)).toPandas().sort_values(["doc_id", "score"]).score.to_numpy() for x in (labels, turned))
    assert np.array_equal(a, b)


def test_quality_without_labels_or_rows(spark, no_docs):
    docs, labels = labelled_docs(spark, 20)
    assert {r.score for r in quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(no_docs, labels, Network(epochs=1)).count() == 0


def test_temperature():
    """Scores are calibrated: labels with a fifth of them turned round get no extreme scores."""
    rng = np.random.default_rng(0)
    how = Network()
    x = rng.normal(size=(4000, how.inputs))
    y = ((x[:, 0] > 0) ^ (rng.random(4000) < 0.2)).astype(int)
    model = fit(x, y, np.arange(4000) % 4 == 0, how)
    assert model.temperature > 1 and abs(model.score(x[x[:, 0] > 1]).mean() - 0.8) < 0.1


def secret_docs(spark):
    rng = random.Random(6)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = []
    for i in range(120):
        rows.append((3 * i, f'{prose(rng, 9)} token = "{key()}" {prose(rng, 5)}', "a/config.py"))
        rows.append((3 * i + 1, f"{prose(rng, 9)} {rng.randrange(10**15, 10**16)} {prose(rng, 5)} commit {key()}", "docs/log.md"))
        rows.append((3 * i + 2, prose(rng, 30), None))
    return spark.createDataFrame(rows + [(1000, None, None), (1001, "", "x")], "doc_id bigint, text string, source string")


def test_secrets(spark, no_docs, odd_docs):
    docs = secret_docs(spark)
    rows = find_secrets(docs.withColumn("found", F.lit("x"))).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r.doc_id][r.start : r.end] == r.found for r in rows) and len(rows) == 360
    assert all(r.is_secret == (r.doc_id % 3 == 0) for r in rows)
    assert find_secrets(no_docs, path=None).count() == 0
    find_secrets(odd_docs).count()


def test_secrets_with_one_label(spark):
    docs = secret_docs(spark).filter("doc_id % 3 = 0")
    assert {r.probability for r in find_secrets(docs, Forest(trees=3)).collect()} == {1.0}


def test_candidate_pattern(spark):
    texts = ["a" * 40, "abcdefgh12345678==", "x" * 30_000 + "1", "short1", "-" * 20_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert {r.i for r in rows.filter(F.col("t").rlike(CANDIDATE)).collect()} == {1, 2}


def test_values_assigned_to_names_of_secrets(spark):
    """Short ones, of letters only, with other signs, quoted or not, have a row each; the forest judges them."""
    texts = {
        'password = "hunter2!" ok': "hunter2!", "pwd: Tr0ub4dor&3, then": "Tr0ub4dor&3", "token=abcdefghijklmnopqrst": "abcdefghijklmnopqrst",
        "the password is correct horse": "correct", "x?token=ab.c&user=me": "ab.c", "{'api_key': 'a b c'}": "a b c", "Auth: Bearer a.b-c.": "a.b-c",
        "password=p@ss0123456789abcdefgh!": "p@ss0123456789abcdefgh!", "PASSWD := `é`": "é", "secret='open": "open",
    }
    more = [("password: null", "null"), ("token = get_token(x)", "get_token(x"), ("no token here", None), ("password:", None)]
    cases = [*texts.items(), *more]
    docs = secret_docs(spark).union(spark.createDataFrame([(2000 + i, t, None) for i, (t, _) in enumerate(cases)], "doc_id bigint, text string, source string"))
    got = defaultdict(list)
    for r in find_secrets(docs).filter("doc_id >= 2000").collect():
        assert cases[r.doc_id - 2000][0][r.start : r.end] == r.found
        got[r.doc_id - 2000].append(r)
    assert [[r.found for r in got[i]] for i in range(len(cases))] == [[v] if v else [] for _, v in cases]
    assert all(got[i][0].is_secret for i in (0, 1, 2, 7))


def test_rows_chosen_by_a_hash(spark):
    from millrace.llm.shared import chosen

    rows = spark.range(0, 50_000, 1, 8)
    got = [r.id for r in chosen(rows, 1000, "id").collect()]
    assert 850 < len(got) <= 1000 and len(set(got)) == len(got) and max(got) > 45_000
    assert sorted(got) == sorted(r.id for r in chosen(rows.repartition(3), 1000, "id").collect())
    assert chosen(rows.limit(5), 1000, "id").count() == 5 and chosen(rows.limit(0), 10, "id").count() == 0


def test_repeated_ids_bring_one_row_to_the_fit(spark):
    """A labelled id with a third of all rows is one labelled row."""
    rng = random.Random(2)
    rows = [(1, prose(rng, 40))] * 60 + [(i, prose(rng, 40)) for i in range(2, 60)]
    labels = [(i, i % 2) for i in range(1, 60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = quality_scores(docs, spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 1}) == 1
