"""Bags of words and term filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import clean_text

# English stop words. Contractions lose their apostrophe with the
# other punctuation before the list is applied.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves "
    "he him his himself she she's her hers herself it it's its itself they them their theirs themselves "
    "what which who whom this that that'll these those am is are was were be been being have has had having "
    "do does did doing a an the and but if or because as until while of at by for with about against between "
    "into through during before after above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other some such no nor not only own "
    "same so than too very s t can will just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn "
    "mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't "
    "wouldn wouldn't"
).split()


def _pieces(column: str | Column) -> Column:
    return F.split(clean_text(column), r"\s+")


def tokens(column: str | Column, stop: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Array of the words of a text: no punctuation, no digits, lower case, no stop words."""
    dropped = ["", *stop]
    return F.filter(_pieces(column), lambda w: ~w.isin(*dropped))


def bag_of_words(df: DataFrame, doc: str, text: str, stop: Sequence[str] = ENGLISH_STOP_WORDS) -> DataFrame:
    """(doc, term, n). The words of one text are counted before the shuffle.

    Words are filtered after the explode, where the test is compiled code; inside
    an array function it would be interpreted.
    """
    return (
        df.select(doc, F.explode(_pieces(text)).alias("term"))
        .filter(~F.col("term").isin("", *stop))
        .groupBy(doc, "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def has_any_term(df: DataFrame, text: str, terms: Sequence[str], exactly_once: bool = False) -> DataFrame:
    """Rows whose text has one of the terms as a word.

    Decided inside the row, so no shuffle. ``exactly_once`` keeps only rows in
    which one of the terms occurs a single time.
    """
    words = _pieces(text)
    if not exactly_once:
        return df.filter(F.arrays_overlap(words, F.array(*[F.lit(t) for t in terms])))
    once = F.exists(
        F.array(*[F.lit(t) for t in terms]), lambda t: F.size(F.filter(F.col("__words"), lambda w: w == t)) == 1
    )
    return df.withColumn("__words", words).filter(once).drop("__words")
