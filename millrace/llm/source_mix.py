"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import group_key, text_or_empty, words, written

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
# A document of so many words or more is taken with FULL_WEIGHT times the odds of a shorter one.
FULL_WORDS, FULL_WEIGHT = 20, 2
# Random numbers are whole numbers below RANDOM; the ranks of a source are cut in
# SLICES, so that only one slice of a source has to be sorted.
RANDOM = 1 << 48
SLICES = 1 << 14


def random_number(doc_id: str, text: str, seed: str = "mix") -> Column:
    """48 random bits of a row, the same in every run; rows equal in id and text share them."""
    parts = F.concat_ws(
        ":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(text_or_empty(text))
    )
    return F.conv(F.substring(F.md5(parts), 1, 12), 16, 10).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Add ``target`` to one row per source (``source``, ``source_size``).

    Sources by code point, NULL last, take the weights in turn. All sizes
    together are shared out by weight; a target stops at ``most`` times its
    source's size and the excess is shared again by weight until none is above.
    That end state is reached directly: ordered by size over weight, the sources
    before some place are at their limit and those behind it get one rate times
    their weight. The windows without a partition run over one row per source.
    """
    n = len(weights)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = sources.withColumn("place", place).withColumn(
        "weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") - 1) % n)
    )
    ranked = ranked.withColumn("limit", (F.lit(most) * F.col("source_size")).cast("double"))
    before = Window.orderBy(F.col("limit") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(F.col("limit") / F.col("weight"), "place").rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ranked = ranked.withColumn(
        "rate",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        / F.sum("weight").over(after),
    )
    rate = F.min(F.when(F.col("limit") / F.col("weight") >= F.col("rate"), F.struct(F.col("limit") / F.col("weight"), F.col("place"), F.col("rate").alias("rate")))).over(everything)["rate"]
    return ranked.withColumn("target", F.least(F.col("limit"), rate * F.col("weight"))).select(
        "source", "source_size", "target"
    )


def document_rates(classes: DataFrame, sources: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """Expected copies of a document, for every source and document weight.

    ``classes`` has ``key``, ``weight`` and ``words`` (of all its documents),
    ``sources`` ``key`` and ``target``. The expected copies are ``rate`` times
    the weight and at most ``most``; within a source the classes of the largest
    weights reach that limit first, and the others share what is left of the
    target. Adds ``whole``, the copies that are certain, and ``chance``, the
    inclusion probability of one more.
    """
    held = classes.join(sources.select("key", "target", "source_size"), "key").withColumn("weight", F.col("weight").cast("double"))
    heavier = Window.partitionBy("key").orderBy(F.desc("weight")).rowsBetween(Window.unboundedPreceding, -1)
    here_on = Window.partitionBy("key").orderBy(F.desc("weight")).rowsBetween(0, Window.unboundedFollowing)
    open_words = F.sum(F.col("weight") * F.col("words")).over(here_on)
    left = F.col("target") - F.lit(float(most)) * F.coalesce(F.sum("words").over(heavier), F.lit(0))
    held = held.withColumn("c", F.when(open_words > 0, left / open_words).otherwise(F.lit(0.0)))
    # The first class that stays within the limit sets the rate; those before it are at the limit.
    fits = F.col("c") * F.col("weight") <= F.lit(float(most))
    rate = F.max(F.when(fits, F.struct(F.col("weight").alias("w"), F.col("c").alias("c")))).over(Window.partitionBy("key"))
    held = held.withColumn("rate", F.coalesce(rate["c"], F.lit(float(most)))).withColumn("top", F.coalesce(rate["w"], F.lit(0.0)))
    expected = F.when(F.col("weight") > F.col("top"), F.lit(float(most))).otherwise(F.col("rate") * F.col("weight"))
    held = held.withColumn("expected", F.least(expected, F.lit(float(most))))
    held = held.withColumn("whole", F.floor("expected").cast("int"))
    return held.withColumn("chance", F.col("expected") - F.col("whole")).select(
        "key", "weight", "words", "source_size", "target", "whole", "chance"
    )


def pareto_rank(u: Column, chance: Column) -> Column:
    """Odds of a document's random number over the odds of its inclusion probability; NULL where that is 0.

    ``u`` is a whole number below ``RANDOM``. Taking the documents of least rank
    gives a sample of fixed size whose inclusion probabilities are close to the
    given ones, however unequal they are.
    """
    x = (u + F.lit(0.5)) / F.lit(float(RANDOM))
    return F.when(chance > 0, x / (F.lit(1.0) - x) / (chance / (F.lit(1.0) - chance)))


def slice_of(rank: Column) -> Column:
    return F.floor(rank / (F.lit(1.0) + rank) * F.lit(SLICES)).cast("int")


def cuts(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """How each source is sampled, from rows ``source``, ``size``, ``u``, ``weight``: one row per source and weight.

    ``whole`` copies of a document are certain. What the target lacks then is
    sampled in Pareto order: the documents of least rank are taken until their
    words come nearest to the need. ``cut`` is the largest rank taken and
    ``cut_slice`` its slice, -1 if none. A source is summed by slices of ranks,
    and only the slice that holds the cut is sorted: one document in about
    ``SLICES``, also of a source with a third of all rows. Documents with equal
    ranks, which are equal in id and text, are taken or left together.
    """
    keyed = sized.withColumn("key", group_key("source"))
    classes = written(
        keyed.groupBy("key", "weight").agg(F.sum("size").alias("words"), F.first("source").alias("source"))
    )
    sources = targets(
        classes.groupBy("key").agg(F.sum("words").alias("source_size"), F.first("source").alias("source")), weights, most
    ).withColumn("key", group_key("source"))
    planned = written(document_rates(classes, sources, most))
    need = planned.groupBy("key").agg((F.max("target") - F.sum(F.col("whole") * F.col("words"))).alias("need"))
    chances = planned.select(F.col("key").alias("p_key"), F.col("weight").alias("p_weight"), "chance")
    chances = F.broadcast(chances) if _few(chances) else chances
    ranked = keyed.join(chances, (F.col("key") == F.col("p_key")) & (F.col("weight").cast("double") == F.col("p_weight")))
    ranked = ranked.withColumn("rank", pareto_rank(F.col("u"), F.col("chance"))).filter("rank IS NOT NULL")
    ranked = ranked.select("key", "size", "rank", slice_of(F.col("rank")).alias("slice"))
    slices = written(ranked.groupBy("key", "slice").agg(F.sum("size").alias("words")))
    running = Window.partitionBy("key").orderBy("slice")
    at = slices.withColumn("upto", F.sum("words").over(running)).join(need, "key")
    # The first slice whose sum reaches the need holds the cut.
    crossing = (
        at.filter(F.col("upto") >= F.col("need"))
        .groupBy("key", "need")
        .agg(F.min(F.struct("slice", (F.col("upto") - F.col("words")).alias("below"))).alias("c"))
        .select(F.col("key").alias("c_key"), "need", F.col("c.slice").alias("c_slice"), F.col("c.below").alias("below"))
    )
    inside = ranked.join(
        F.broadcast(crossing) if _few(crossing) else crossing,
        (F.col("key") == F.col("c_key")) & (F.col("slice") == F.col("c_slice")),
    )
    inside = inside.groupBy("key", "rank", "need", "below", "c_slice").agg(F.sum("size").alias("size"))
    upto = F.col("below") + F.sum("size").over(Window.partitionBy("key").orderBy("rank"))
    best = (
        inside.withColumn("miss", F.abs(F.col("need") - upto))
        .groupBy("key", "need", "below", "c_slice")
        .agg(F.min(F.struct("miss", "rank")).alias("b"))
        .select(
            "key", F.col("c_slice").alias("cut_slice"),
            F.when(F.col("b.miss") < F.abs(F.col("need") - F.col("below")), F.col("b.rank")).otherwise(F.lit(-1.0)).alias("cut"),
        )
    )
    out = planned.join(need, "key").join(best, "key", "left")
    some = F.col("need") > 0
    return out.select(
        "key", "weight", "source_size", "target", "whole", "chance",
        # Where the need is beyond all slices every document is taken.
        F.when(some, F.coalesce("cut_slice", F.lit(SLICES))).otherwise(F.lit(-1)).alias("cut_slice"),
        F.when(some, F.coalesce("cut", F.lit(-1.0))).otherwise(F.lit(-1.0)).alias("cut"),
    )


def _few(rows: DataFrame, most: int = 10_000) -> bool:
    """Whether there are at most ``most`` rows: the proven bound of a broadcast."""
    return len(rows.select(F.lit(1)).limit(most + 1).collect()) <= most


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    prefix: str = "",
    document_weight: Column | None = None,
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` to every row.

    ``size`` is the number of words, ``copies`` how often the mix takes the
    document, ``taken`` the words of all copies. A document is expected as often
    as its weight asks for within its source: ``document_weight``, a number that
    is not negative and has few different values, or else ``FULL_WEIGHT`` for
    documents of ``FULL_WORDS`` words or more and 1 for shorter ones. NULL
    weights count as 0. Texts are read once for the sizes; these narrow rows are
    written and everything else works on them and on one row per source and
    weight. An empty or NULL text has size 0. A source's taken words miss its
    target by at most half of the words of the documents with one id and text,
    as long as the documents with a weight have enough of them. Runs agree,
    because the random numbers are hashes of id and text.
    """
    p = prefix
    rows = docs.withColumns(
        {f"{p}size": F.size(words(text_or_empty(text))).cast("long"), f"{p}u": random_number(doc_id, text)}
    )
    full = F.when(F.col(f"{p}size") >= FULL_WORDS, F.lit(float(FULL_WEIGHT))).otherwise(F.lit(1.0))
    given = full if document_weight is None else F.greatest(F.coalesce(document_weight.cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = rows.withColumn(f"{p}weight", given)
    sized = written(
        rows.select(F.col(source).alias("source"), *[F.col(f"{p}{c}").alias(c) for c in ("size", "u", "weight")])
    )
    plan = written(cuts(sized, weights, most))
    names = plan.columns
    plan = plan.select(*[F.col(c).alias(f"{p}plan_{c}") for c in names])
    plan = F.broadcast(plan) if _few(plan) else plan
    joined = rows.join(plan, (group_key(source) == plan[f"{p}plan_key"]) & (rows[f"{p}weight"] == plan[f"{p}plan_weight"]), "left")
    rank = pareto_rank(F.col(f"{p}u"), F.col(f"{p}plan_chance"))
    at, cut_slice = slice_of(rank), F.col(f"{p}plan_cut_slice")
    sampled = F.coalesce((at < cut_slice) | ((at == cut_slice) & (rank <= F.col(f"{p}plan_cut"))), F.lit(False))
    copies = F.col(f"{p}plan_whole") + sampled.cast("int")
    return joined.withColumns(
        {
            f"{p}source_size": F.col(f"{p}plan_source_size"),
            f"{p}target": F.col(f"{p}plan_target"),
            f"{p}copies": copies,
            f"{p}taken": copies * F.col(f"{p}size"),
        }
    ).drop(f"{p}u", f"{p}weight", *[f"{p}plan_{c}" for c in names])


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: each document as often as it is taken, with its columns."""
    p = "__mix_"
    times = F.explode(F.sequence(F.lit(1), F.col(f"{p}copies")))
    taken = mix(docs, doc_id, text, source, prefix=p).filter(F.col(f"{p}copies") > 0)
    return taken.select(*[F.col(c) for c in docs.columns], times.alias(f"{p}copy")).drop(f"{p}copy")
