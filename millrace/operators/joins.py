"""Lookups, star joins, anti and semi joins.

Sides read from files are not hinted: Spark knows their size, broadcasts them
under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles anything larger,
splitting hot keys at run time. For sides that are themselves joins or
aggregates AQE turns the join into a broadcast when the bytes it has measured
are few. A hint would turn a dimension that has grown into a failed job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _all(conds: Sequence[Column]) -> Column:
    return reduce(Column.__and__, conds)


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    cols: Mapping[str, str],
    how: str = "left",
    extra: Column | None = None,
) -> DataFrame:
    """Add dimension columns: ``on`` is {fact column: dim column}, ``cols`` {new: dim column}.

    With ``how="left"`` a miss leaves NULL; with ``"inner"`` the row drops.
    ``extra`` is a condition on dimension columns that belongs to the join, so
    that rows it removes count as misses.
    """
    if extra is not None:
        dim = dim.filter(extra)
    keys = {f"__{i}_{d}": d for i, d in enumerate(on.values())}
    # A select keeps a broadcast hint of the dimension.
    slim = dim.select(
        *[F.col(d).alias(k) for k, d in keys.items()], *[F.col(old).alias(new) for new, old in cols.items()]
    )
    cond = _all([df[f] == slim[k] for f, k in zip(on, keys)])
    return df.join(slim, cond, how).drop(*keys)


def lookup_date_key(df: DataFrame, dates: DataFrame, on: str, as_: str, how: str = "inner") -> DataFrame:
    """Date-dimension key of a date column; unmatched rows drop unless ``how="left"``."""
    return lookup(df, dates, {on: "date_dt"}, {as_: "date_key"}, how)


@dataclass(frozen=True)
class Lookup:
    """One arm of a star join."""

    dim: DataFrame
    on: Mapping[str, str]
    cols: Mapping[str, str]
    extra: Column | None = None
    how: str = field(default="left")


def star_join(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Chain of lookups; later ones may use columns added by earlier ones."""
    return reduce(lambda df, lk: lookup(df, lk.dim, lk.on, lk.cols, lk.how, lk.extra), lookups, fact)


def one_per_key(dim: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Dimension with one row per key: smallest value of each carried column set."""
    if not carry:
        return dim.select(*keys).distinct()
    return dim.groupBy(*keys).agg(F.min(F.struct(*carry)).alias("__c")).select(
        *keys, *[F.col(f"__c.{c}").alias(c) for c in carry]
    )


def double_lookup(
    df: DataFrame,
    dim: DataFrame,
    first: Mapping[str, str],
    second: Mapping[str, str],
    active: Column,
) -> DataFrame:
    """Keep rows that match the active dimension rows under both key sets.

    Semi joins: a dimension that lists a key twice cannot multiply rows.
    """
    live = dim.filter(active)

    def keep(left: DataFrame, on: Mapping[str, str]) -> DataFrame:
        return join_back(left, live.select(*[F.col(d).alias(f) for f, d in on.items()]).distinct(), list(on), "left_semi")

    return keep(keep(df, first), second)


def double_match(
    df: DataFrame,
    dim: DataFrame,
    first: Mapping[str, str],
    second: Mapping[str, str],
    active: Column,
    into: str,
) -> DataFrame:
    """Like ``double_lookup``, but marks the rows in a boolean column and keeps all of them."""
    live = dim.filter(active)
    for i, on in enumerate((first, second)):
        side = live.select(*[F.col(d).alias(f) for f, d in on.items()]).distinct()
        df = join_back(df, side.withColumn(f"__hit{i}", F.lit(True)), list(on), "left")
    return df.withColumn(into, F.col("__hit0").isNotNull() & F.col("__hit1").isNotNull()).drop("__hit0", "__hit1")


def convert_currency(
    df: DataFrame,
    rates: DataFrame,
    dates: DataFrame,
    currencies: DataFrame,
    how: str = "inner",
) -> DataFrame:
    """Add date_create_key, date_currency_key, exchange rate and currency decimals.

    The rate is the one of the booking date and currency. ``df`` has
    ``create_date`` and ``currency_code``; see ``fx_table`` for the dimensions.
    """
    fx = fx_table(rates, dates, currencies)
    cond = (df["create_date"] == fx["creation_date"]) & (df["currency_code"] == fx["currency_iso_cd"])
    return df.join(fx, cond, how).drop("creation_date", "currency_iso_cd")


def fx_table(rates: DataFrame, dates: DataFrame, currencies: DataFrame) -> DataFrame:
    """Rates by calendar date and currency, with the currency's decimal places.

    Columns: rates (currency_iso_cd, date_currency_key, date_key,
    exch_per_us_dlr_rte), dates (date_key, date_dt), currencies
    (currency_iso_cd, decimal_positions_qty).
    """
    by_date = rates.join(
        dates.select(F.col("date_key").alias("date_create_key"), F.col("date_dt").alias("creation_date")),
        F.col("date_key") == F.col("date_create_key"),
    )
    return by_date.join(currencies.select("currency_iso_cd", "decimal_positions_qty"), "currency_iso_cd").select(
        "creation_date", "currency_iso_cd", "date_currency_key", "date_create_key", "exch_per_us_dlr_rte",
        "decimal_positions_qty",
    )


def as_wide(c: Column, other: T.DataType) -> Column:
    """The column in the type in which it compares with ``other``; hashes differ between types."""
    return F.coalesce(c, F.lit(None).cast(other))


def join_back(parent: DataFrame, child: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join values grouped by key back to the rows of that key; keys kept once.

    A grouped side is already partitioned by the key, so Spark would join it as
    it is. AQE then cannot split a hot key of the parent side, because it only
    does so between two shuffles. A hash of the key as an extra join column asks
    for a partitioning of its own; the grouped side, one row per key, is
    shuffled once more, and hot keys are split.
    """
    marked = child.select(*[F.col(c) if c not in keys else F.col(c).alias(f"__{c}") for c in child.columns])
    marked = marked.withColumn("__hash", F.xxhash64(*[as_wide(F.col(f"__{k}"), parent.schema[k].dataType) for k in keys]))
    hashed = F.xxhash64(*[as_wide(parent[k], child.schema[k].dataType) for k in keys])
    cond = _all([hashed == marked["__hash"], *[parent[k] == marked[f"__{k}"] for k in keys]])
    return parent.join(marked, cond, how).drop("__hash", *[f"__{k}" for k in keys])


# --- anti and semi joins ----------------------------------------------------------


def anti_missing(a: DataFrame, b: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """NOT EXISTS: rows of ``a`` without a match; NULL keys of ``a`` stay."""
    return join_back(a, b.select(*[F.col(r).alias(l) for l, r in keys.items()]).distinct(), list(keys), "left_anti")


def anti_not_in(a: DataFrame, b: DataFrame, key: str, other: str | None = None) -> DataFrame:
    """NOT IN with its NULL rules: a NULL in ``b`` empties the result.

    Spark runs ``NOT IN`` as a broadcast join whatever the size of ``b``.
    Here the rule is a one-row scalar subquery and the rest an ordinary anti
    join, which can be shuffled.
    """
    side = b.select(F.col(other or key).alias("__k"))
    facts = side.agg(
        F.struct(
            F.coalesce(F.bool_or(F.col("__k").isNull()), F.lit(False)).alias("has_null"),
            (F.count(F.lit(1)) == 0).alias("empty"),
        ).alias("f")
    ).scalar()
    kept = join_back(a, side.distinct().withColumnRenamed("__k", key), [key], "left_anti")
    return kept.filter(~facts["has_null"] & (F.col(key).isNotNull() | facts["empty"]))


def already_loaded(df: DataFrame, target: DataFrame, keys: Sequence[str], null_as: Mapping[str, object] | None = None) -> DataFrame:
    """EXISTS: rows whose key is in the target. ``null_as`` lets NULL keys match."""
    null_as = null_as or {}

    def norm(frame: DataFrame, k: str) -> Column:
        return F.coalesce(frame[k], F.lit(null_as[k])) if k in null_as else frame[k]

    side = target.select(*[norm(target, k).alias(f"__{k}") for k in keys]).distinct()
    typed = df.select(*[norm(df, k).alias(k) for k in keys]).schema
    side = side.withColumn("__hash", F.xxhash64(*[as_wide(F.col(f"__{k}"), typed[k].dataType) for k in keys]))
    hashed = F.xxhash64(*[as_wide(norm(df, k), side.schema[f"__{k}"].dataType) for k in keys]) == side["__hash"]
    return df.join(side, _all([hashed, *[norm(df, k) == side[f"__{k}"] for k in keys]]), "left_semi")


# Bits of a hashed key set: 16 to a key, up to 32 MB, in blocks of 4 KB.
KEY_BITS, MOST_KEY_BITS, BLOCK_BITS = 16, 1 << 28, 1 << 15


def maybe_in(df: DataFrame, other: DataFrame, key: str, other_rows: int, into: str) -> DataFrame:
    """Add a boolean column that is false for rows whose key is surely not in ``other``.

    ``other``'s keys are hashed into bits that go to all tasks, a few megabytes
    whatever its size: with 16 bits a key at most one other row in 16 passes; a
    set that is too large for this lets more rows pass, never fewer. NULL is in no set.
    """
    bits = min(MOST_KEY_BITS, max(BLOCK_BITS, 1 << (KEY_BITS * other_rows - 1).bit_length()))

    def at(frame: DataFrame, like: DataFrame) -> Column:
        return F.xxhash64(as_wide(F.col(key), like.schema[key].dataType)).bitwiseAND(F.lit(bits - 1))

    def block(place: Column) -> Column:
        return F.shiftright(place, 15).cast("int")

    # Words of 64 bits whose first byte is the highest: bit p of a block is bit (p % 64) ^ 56 of its word.
    def word(i: Column) -> Column:
        half = lambda k: F.conv(F.hex(F.substring(F.col("__bytes"), i * 8 + 4 * k + 1, F.lit(4))), 16, 10).cast("long")
        return F.shiftleft(half(0), 32).bitwiseOR(half(1))

    place = at(other, df)
    held = other.filter(F.col(key).isNotNull()).groupBy(block(place).alias("__block")).agg(
        F.bitmap_construct_agg(place.bitwiseAND(F.lit(BLOCK_BITS - 1))).alias("__bytes")
    )
    words = held.select("__block", F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1)), word).alias("__words"))
    mine = at(df, other)
    joined = df.withColumn("__at", F.when(F.col(key).isNotNull(), mine)).join(F.broadcast(words), block(F.col("__at")) == F.col("__block"), "left")
    its = F.get(F.col("__words"), F.shiftright(F.col("__at").bitwiseAND(F.lit(BLOCK_BITS - 1)), 6).cast("int"))
    bit = F.call_function("bit_get", its, F.col("__at").bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56)).cast("int"))
    return joined.withColumn(into, F.coalesce(bit == 1, F.lit(False))).select(*df.columns, into)


def matched_rows(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that keeps matched rows only, i.e. an inner join."""
    return a.join(b, list(keys), "inner")


def attribute_lookup(
    df: DataFrame,
    attrs: DataFrame,
    key: str,
    attr_key: str,
    name: str,
    value: str,
    columns: Mapping[str, str],
) -> DataFrame:
    """One column per named attribute, its smallest value, NULL when absent.

    ``columns`` is {new column: attribute name}. All attributes come from one
    grouped pass instead of one correlated subquery each.
    """
    wide = (
        attrs.filter(F.col(name).isin(*columns.values()))
        .groupBy(F.col(attr_key).alias("__key"))
        .agg(*[F.min(F.when(F.col(name) == n, F.col(value))).alias(c) for c, n in columns.items()])
    )
    return join_back(df, wide.withColumnRenamed("__key", key), [key], "left")


def gate(df: DataFrame, report: DataFrame) -> DataFrame:
    """All rows when no check failed, none otherwise, decided inside the query.

    For reads. A load should decide before it writes: ``quality.publish_if_clean``.
    """
    failed = report.agg(F.count_if(F.col("error_code") > 0).alias("n")).scalar()
    return df.filter(failed == 0)
