"""Exact duplicates by recipes of content-defined chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import lower_ascii, text_or_empty, written
from millrace.operators.joins import join_back

# A chunk has at least SMALLEST characters and ends after the first cut mark
# behind them; where no mark comes it ends at LARGEST. Marks are read from the
# text alone, so equal passages are cut alike wherever they stand.
SMALLEST, LARGEST = 2048, 16384
CUT = r"[.!?\n](?=[\s\S])"
# Ids that a broadcast list has at most.
BROADCAST_IDS = 500_000


def chunks(text: Column) -> Column:
    """Chunks of a text in order; their concatenation is the text. None for an empty text."""
    pattern = rf"[\s\S]{{{SMALLEST}}}[\s\S]{{0,{LARGEST - SMALLEST}}}?{CUT}|[\s\S]{{1,{LARGEST}}}"
    return F.when(F.length(text) <= SMALLEST, F.filter(F.array(text), lambda x: x != "")).otherwise(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    )


def with_recipe(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Add ``text_sha256`` and ``recipe``, the ordered identifiers of the chunks.

    An identifier is the chunk's length and 64-bit hash. Recipes in which one
    stands for more than one chunk are found by ``mixed_recipes``.
    """
    p = prefix
    held = docs.withColumn(f"{p}norm", lower_ascii(text_or_empty(text)))
    held = held.withColumn(f"{p}chunks", chunks(F.col(f"{p}norm")))
    return held.withColumns(
        {
            f"{p}text_sha256": F.sha2(f"{p}norm", 256),
            f"{p}recipe": F.transform(
                f"{p}chunks", lambda c: F.struct(F.length(c).alias("n"), F.xxhash64(c).alias("h"))
            ),
        }
    ).drop(f"{p}norm")


def mixed_recipes(rows: DataFrame, prefix: str = "") -> DataFrame:
    """Recipes ``r`` that stand for more than one text: normally none.

    An identifier that stands for different chunks shows in the SHA-256 of the
    texts that have its recipe. A recipe is sent once per task.
    """
    sha = F.col(f"{prefix}text_sha256")
    found = rows.groupBy(F.col(f"{prefix}recipe").alias("r")).agg(F.min(sha).alias("lo"), F.max(sha).alias("hi"))
    return found.filter("lo <> hi").select("r")


def duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prefix: str = "", with_text: bool = True) -> DataFrame:
    """Add ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` to every row; without ``with_text`` the text goes.

    Texts are equal when their recipes are equal: the same identifiers in the
    same order. Where a recipe stands for texts that differ in their SHA-256,
    that is compared as well. Of equal texts the
    row with the largest ``doc_id`` stays; NULL ids are smaller than all others,
    and rows that repeat the kept id with the same text stay together. NULL and
    empty texts are equal to each other. The texts are read in one pass, the
    recipes, about one identifier per two thousand characters, are written once,
    checked and joined with their groups; hot groups are counted before the
    shuffle and split by AQE in the join.
    """
    p = prefix
    full = with_recipe(docs, text, p)
    rows = written(full.drop(f"{p}chunks", *([] if with_text else [text])))
    mixed = written(mixed_recipes(rows, p))
    key = f"{p}key"
    # Outside the rare mixed recipes the second part of the key is empty.
    if mixed.isEmpty():
        rows = rows.withColumn(key, F.struct(F.col(f"{p}recipe").alias("r"), F.lit("").alias("s")))
    else:
        rows = join_back(rows.withColumn("r", F.col(f"{p}recipe")), mixed.withColumn("bad", F.lit(True)), ["r"], "left")
        rows = rows.withColumn(
            key,
            F.struct(F.col("r"), F.when(F.col("bad"), F.col(f"{p}text_sha256")).otherwise(F.lit("")).alias("s")),
        ).drop("r", "bad")
    rows = rows.drop(f"{p}recipe")
    groups = rows.groupBy(key).agg(
        F.max(doc_id).alias(f"{p}keep_id"), F.count(F.lit(1)).alias(f"{p}group_size")
    )
    return (
        join_back(rows, groups, [key])
        .withColumn(f"{p}kept", F.col(doc_id).eqNullSafe(F.col(f"{p}keep_id")))
        .drop(key)
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every group of equal texts, with the columns it came with.

    Only ids and recipes are grouped. The texts are read again without the ids
    that go, at most ``BROADCAST_IDS`` of which are broadcast (about 100 bytes
    each); more are joined by a shuffle. Of rows that repeat an id and a text one
    stays.
    """
    p = "__copies_"
    found = duplicates(docs.select(doc_id, text), doc_id, text, p, with_text=False)
    found = written(found.select(F.col(doc_id).alias(f"{p}id"), F.col(f"{p}text_sha256").alias(f"{p}gone"), f"{p}kept"))
    gone = found.filter(~F.col(f"{p}kept")).select(f"{p}id", f"{p}gone").distinct()
    few = gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    rows = docs.withColumn(f"{p}sha", F.sha2(lower_ascii(text_or_empty(text)), 256))
    same = rows[doc_id].eqNullSafe(gone[f"{p}id"]) & (rows[f"{p}sha"] == gone[f"{p}gone"])
    kept = rows.join(F.broadcast(gone) if few else gone, same, "left_anti")
    repeated = found.filter(f"{p}kept").groupBy(f"{p}id", f"{p}gone").count().filter("count > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates([doc_id, f"{p}sha"])
    return kept.drop(f"{p}sha")
