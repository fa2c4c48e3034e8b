"""Labels, split, random forest, evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import crosstab
from millrace.operators.forest import Forest, grow
from millrace.operators.project import first_match

# Rating text to label; anything else is 6.
RATINGS = {"Critical": 1, "Major": 2, "Moderate": 3, "Minor": 4, "Insignificant": 5}
OTHER_RATING = 6


def rating_label(column: str | Column) -> Column:
    return first_match(column, RATINGS, OTHER_RATING).cast("int")


def fill_zero(df: DataFrame, *columns: str) -> DataFrame:
    return df.na.fill(0, list(columns) or None)


def in_train(key: str | Column, share: float = 0.75, seed: int = 0) -> Column:
    """True for about ``share`` of the keys.

    A row's side depends on its key and the seed only, not on partitioning, so
    the split can be repeated and a key never lands on both sides.
    """
    text = F.concat_ws("|", F.lit(str(seed)), (F.col(key) if isinstance(key, str) else key).cast("string"))
    bucket = F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("long") % 1000
    return bucket < int(share * 1000)


def split(df: DataFrame, key: str, share: float = 0.75, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    train = in_train(key, share, seed)
    return df.filter(train), df.filter(~train)


@dataclass(frozen=True)
class Classifier:
    """A forest and the column whose words it reads."""

    forest: Forest
    words: str

    def transform(self, df: DataFrame) -> DataFrame:
        return self.forest.transform(df, self.words)


def train_classifier(
    train: DataFrame, words: str, label: str, trees: int = 100, seed: int = 10, n_features: int = 1 << 18,
    max_depth: int = 30,
) -> Classifier:
    """Random forest on word counts. Runs jobs.

    Words are hashed into so many columns that few of them share one; no
    vocabulary passes through the driver. Spark's own forest turns every row
    into an array over all columns, a megabyte at this many; ``forest`` keeps
    rows sparse.
    """
    return Classifier(grow(train, words, label, trees, seed, n_features, max_depth), words)


def evaluate(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: rows and accuracy."""
    return pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col(label).cast("double") == F.col(prediction)).cast("double")).alias("accuracy"),
    )


def confusion(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Counts of actual against predicted labels."""
    return crosstab(
        pred.select(F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted")),
        "actual",
        "predicted",
    )
