"""Words, HTML, classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.registry import query
from millrace.operators import classify as C
from millrace.operators import html as H
from millrace.operators import words as W
from millrace.sources.tables import Tables

STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in W.ENGLISH_STOP_WORDS)
TOKENS_SQL = r"""
    string_split(trim(regexp_replace(lower(regexp_replace(regexp_replace(text, '[!-/:-@\[-`{-~]', '', 'g'), '\p{Nd}', '', 'g')), '\s+', ' ', 'g')), ' ')
"""


@query(f"""
    SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest({TOKENS_SQL}) AS term FROM documents)
    WHERE term <> '' AND term NOT IN ({STOP_SQL}) GROUP BY ALL
""")
def words_bag(t: Tables) -> DataFrame:
    return W.bag_of_words(t.documents, "doc_id", "text")


TERMS = ("haha", "erst", "nicht")


@query(f"SELECT doc_id FROM documents WHERE list_has_any({TOKENS_SQL}, {list(TERMS)})")
def words_any_term(t: Tables) -> DataFrame:
    return W.has_any_term(t.documents.select("doc_id", "text"), "text", TERMS).select("doc_id")


@query(f"""
    SELECT doc_id FROM (SELECT doc_id, unnest({TOKENS_SQL}) AS term FROM documents) WHERE term IN {TERMS}
    GROUP BY doc_id HAVING min(1) = 1 AND doc_id IN (
        SELECT doc_id FROM (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest({TOKENS_SQL}) AS term FROM documents)
                            WHERE term IN {TERMS} GROUP BY ALL) WHERE n = 1)
""")
def words_term_once(t: Tables) -> DataFrame:
    return W.has_any_term(t.documents.select("doc_id", "text"), "text", TERMS, exactly_once=True).select("doc_id")


@query("SELECT DISTINCT lang, md5(text) AS text_key, n_chars FROM documents")
def documents_distinct(t: Tables) -> DataFrame:
    return t.documents.select("lang", F.md5("text").alias("text_key"), "n_chars").dropDuplicates()


# Links of a page, by splitting at tags: independent of the operator's patterns.
# The pages hold no quoted ">" and no spaces around "="; the unit tests do.
HREFS_SQL = """
    links AS (
        SELECT page_id, string_split(split_part(split_part(piece, 'href="', 2), '"', 1), chr(10)) AS lines
        FROM (SELECT page_id, unnest(string_split(string_split(html, '<body>')[2], '<a ')[2:]) AS piece FROM pages)
        WHERE contains(split_part(piece, '>', 1), 'href="')),
    hits AS (SELECT page_id, length(replace(unnest(lines), '&amp;', '&')) AS n FROM links)
"""


@query(f"""
    WITH {HREFS_SQL} SELECT p.page_id, count(*) FILTER (h.n = 11) AS n FROM pages p LEFT JOIN hits h USING (page_id) GROUP BY 1
""")
def html_links_of_length(t: Tables) -> DataFrame:
    return H.count_elements(t.pages, "html", "a", "href", 11, by=["page_id"])


@query(f"WITH {HREFS_SQL} SELECT count(*) FILTER (n = 4) AS n FROM hits")
def html_links_total(t: Tables) -> DataFrame:
    return H.count_elements(t.pages, "html", "a", "href", 4)


@query("""
    SELECT p_partkey, 1 AS row, 'name' AS header, p_name AS value FROM part
    UNION ALL SELECT p_partkey, 1, 'brand', p_brand FROM part
    UNION ALL SELECT p_partkey, 1, 'size', CAST(p_size AS VARCHAR) FROM part
    UNION ALL SELECT p_partkey, 2, 'name', p_type FROM part
    UNION ALL SELECT p_partkey, 2, 'brand', NULL FROM part
    UNION ALL SELECT p_partkey, 2, 'size', 'a&b' FROM part
""")
def html_table_cells(t: Tables) -> DataFrame:
    page = F.concat(
        F.lit("<html><body><table><tr><th>skipped</th></tr><tr><th>name</th><th>brand</th><th>size</th></tr><tr><td>"),
        F.col("p_name"), F.lit("</td><td><b>"), F.col("p_brand"), F.lit("</b></td><td>"), F.col("p_size").cast("string"),
        F.lit("</td></tr><tr><td>one</td><td>two</td></tr><tr><td>"), F.col("p_type"),
        F.lit("<td>a<br>b<td>a&amp;b</tr></table></body></html>"),
    )
    return H.html_tables(t.part.select("p_partkey", page.alias("html")), "p_partkey", "html", 3)


@query("""
    SELECT doc_id, CASE quality * 2 + toxic WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 5 ELSE 6 END AS label FROM labels
""")
def classify_label(t: Tables) -> DataFrame:
    code = F.col("quality") * 2 + F.col("toxic")
    rating = F.when(code == 0, "Major").when(code == 1, "Critical").when(code == 2, "Insignificant").otherwise("Other")
    return t.labels.select("doc_id", C.rating_label(rating).alias("label"))


@query("SELECT n_nationkey, coalesce(nullif(n_regionkey, 2), 0) AS region FROM nation")
def classify_fill_zero(t: Tables) -> DataFrame:
    return C.fill_zero(t.nation.select("n_nationkey", F.nullif(F.col("n_regionkey"), F.lit(2)).alias("region")))


@query("SELECT doc_id, CAST('0x' || left(md5('7|' || doc_id), 6) AS BIGINT) % 1000 < 750 AS is_train FROM labels")
def classify_split(t: Tables) -> DataFrame:
    return t.labels.select("doc_id", C.in_train("doc_id", 0.75, 7).alias("is_train"))


def _predictions(t: Tables) -> DataFrame:
    docs = t.documents.join(t.labels, "doc_id").select(
        "doc_id", W.tokens("text").alias("words"), F.col("quality").cast("double").alias("label")
    )
    train, test = C.split(docs, "doc_id", 0.75, 7)
    return C.train_classifier(train, "words", "label").transform(test)


TEST_SQL = """
    test AS (SELECT doc_id, quality FROM documents JOIN labels USING (doc_id)
             WHERE CAST('0x' || left(md5('7|' || doc_id), 6) AS BIGINT) % 1000 >= 750)
"""


@query(f"WITH {TEST_SQL} SELECT count(*) AS n FROM test")
def classify_accuracy(t: Tables) -> DataFrame:
    """Rows that were judged; a unit test holds the accuracy against a floor."""
    return C.evaluate(_predictions(t), "label").select("n")


@query(f"WITH {TEST_SQL} SELECT quality AS actual, count(*) AS n FROM test GROUP BY 1")
def classify_confusion(t: Tables) -> DataFrame:
    """Counts by actual label, summed over what was predicted."""
    cells = C.confusion(_predictions(t), "label")
    return cells.groupBy("actual").agg(F.sum("n").alias("n"))
