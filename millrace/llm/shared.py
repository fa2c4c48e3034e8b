"""Helpers that several operators of this package use."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import ensure_checkpoint_dir, tune
from millrace.sinks.folders import Folder
from millrace.sources.tables import Tables

# White space that separates words; every other character belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"

# Deletes the shuffle files of a job at its end; Spark reads it when the job is planned.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(tune(spark), folder))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function of the tables under its own name."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[build.__name__] = Query(build.__name__, build, sql)
        return build

    return register


_SCRATCH: ContextVar[list[str] | None] = ContextVar("millrace_scratch", default=None)


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage: what was read once is not computed again, also after
    executors are lost. Needs one job. Unlike ``checkpoint()`` the files are
    compressed columns, and their size is known to later joins. Inside of
    ``scratch`` the table lasts until its end. The job's shuffle files, which
    the table replaces, go when it ends and not when the driver happens to
    collect its garbage.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/millrace-{uuid.uuid4().hex}"
    held = _SCRATCH.get()
    if held is not None:
        held.append(path)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end every table that ``written`` makes in between, also when a step fails.

    What is returned from inside must not read them any more: write it first,
    with a scope of its own around what it is made of. A scope inside another
    one leaves the other's tables alone.
    """
    paths: list[str] = []
    token = _SCRATCH.set(paths)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        root = Folder(spark, ensure_checkpoint_dir(spark))
        for path in paths:
            root.delete(path.rsplit("/", 1)[1])


def text_or_empty(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Words of a text in order; an empty array when there are none."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Texts of ASCII characters alone take the faster ``lower``."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def group_key(column: str | Column) -> Column:
    """A key that is never NULL: NULL is a group of its own, apart from every text."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def chosen(rows: DataFrame, most: int, *by: str) -> DataFrame:
    """At most ``most`` rows, chosen by a hash of ``by``: the same in every run.

    Rows above a share of the hash's range are left out first, so that about
    ``most`` rows in all, and not ``most`` of every task, come together to be
    cut. Needs one count; up to ``most`` rows nothing is left out.
    """
    n = rows.count()
    if n <= most:
        return rows
    place = F.pmod(F.xxhash64(*by), F.lit(1 << 30))
    return rows.filter(place < F.lit(int((1 << 30) * most / n))).orderBy(place, *by).limit(most)
