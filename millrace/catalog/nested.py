"""Arrays built from the columns of a row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.registry import query
from millrace.operators import nested as N
from millrace.sources.tables import Tables


def _arrays(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey", F.split("p_name", " ").alias("words"),
        F.split(F.concat_ws("#", "p_brand", "p_type"), "#").alias("marks"),
    )


ARRAYS_SQL = """
    SELECT p_partkey, string_split(p_name, ' ') AS words, string_split(concat_ws('#', p_brand, p_type), '#') AS marks FROM part
"""


@query(f"SELECT p_partkey, word, mark FROM (SELECT p_partkey, word, unnest(marks) AS mark FROM (SELECT *, unnest(words) AS word FROM ({ARRAYS_SQL})))")
def nested_product(t: Tables) -> DataFrame:
    return N.explode_product(_arrays(t), {"word": "words", "mark": "marks"}).select("p_partkey", "word", "mark")


@query(f"SELECT p_partkey, z[1] AS word, z[2] AS mark, pos - 1 AS position FROM (SELECT p_partkey, unnest(list_zip(words, marks)) AS z, unnest(range(1, greatest(len(words), len(marks)) + 1)) AS pos FROM ({ARRAYS_SQL}))")
def nested_aligned(t: Tables) -> DataFrame:
    return N.explode_aligned(_arrays(t), {"word": "words", "mark": "marks"}, position="position").select(
        "p_partkey", "word", "mark", "position"
    )


@query(f"SELECT p_partkey, z[1] AS word, z[2] AS mark FROM (SELECT p_partkey, unnest(list_zip(words[:2], marks[:2])) AS z FROM ({ARRAYS_SQL}))")
def nested_aligned_shortest(t: Tables) -> DataFrame:
    return N.explode_aligned(_arrays(t), {"word": "words", "mark": "marks"}, keep_short=False).select(
        "p_partkey", "word", "mark"
    )


@query("""
    SELECT doc_id, word, count(*) AS n
    FROM (SELECT doc_id, unnest(string_split(line, ' ')) AS word FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents))
    GROUP BY ALL
""")
def nested_path(t: Tables) -> DataFrame:
    lines = F.transform(F.split("text", "\n"), lambda l: F.struct(F.split(l, " ").alias("words")))
    # Texts are dealt, not their words: a word costs more as a row of its own. In many parts, as a task holds its part's words.
    parts = 2 * int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    docs = t.documents.select("doc_id", "text").repartition(parts, "doc_id").select("doc_id", F.struct(lines.alias("lines")).alias("body"))
    return N.explode_path(docs, "body.lines.words", "word").groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT c_custkey, c_mktsegment AS name, c_nationkey AS nation, 2 - CAST(c_acctbal <= 5000 AS INTEGER) AS items FROM customer
""")
def nested_struct(t: Tables) -> DataFrame:
    s = N.pairs(name="c_mktsegment", nation="c_nationkey")
    some = N.present([s, F.when(F.col("c_acctbal") > 5000, s)])
    out = t.customer.select("c_custkey", some.alias("items"))
    return out.select(
        "c_custkey", F.get("items.name", F.lit(0)).alias("name"), F.get("items.nation", F.lit(0)).alias("nation"),
        F.size("items").alias("items"),
    )
