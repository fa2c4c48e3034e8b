"""Data-quality checks, the check report, and the publish gate.

All checks of a table are computed in one pass: the table is read once and
shuffled once whatever the number of checks. Key sets that contain another one
are a family with it: rows are dealt by a fingerprint of the smallest set, which
brings the rows of each larger key together as well, and a row is shuffled once
for a family, with the columns that the larger sets add. Keys are mostly
different, so rows are not combined before the shuffle: that would gather the
keys of a task in memory and save nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.money import money
from millrace.operators.joins import already_loaded, as_wide
from millrace.operators.nested import present


@dataclass(frozen=True)
class NotEmpty:
    code: str = "NO_RECORDS_LOADED"


@dataclass(frozen=True)
class Unique:
    """No two rows share the key. The report counts the keys that repeat."""

    cols: tuple[str, ...]
    code: str = "DUPLICATE_RECORDS"


@dataclass(frozen=True)
class NoNulls:
    """No key column is NULL. The report counts rows."""

    cols: tuple[str, ...]
    code: str = "NULL_KEY"


@dataclass(frozen=True)
class SumsTo:
    """The rounded sum per key equals ``total``. The report counts keys."""

    keys: tuple[str, ...]
    amount: str
    total: int = 100
    code: str = "INVALID_AMOUNT"
    at_most: bool = False


def SumsAtMost(keys: tuple[str, ...], amount: str, total: int = 100, code: str = "INVALID_AMOUNT") -> SumsTo:
    """The rounded sum per key does not exceed ``total``."""
    return SumsTo(keys, amount, total, code, at_most=True)


@dataclass(frozen=True)
class NotInTarget:
    """No row's key is already in the target. The report counts rows."""

    target: DataFrame
    keys: tuple[str, ...]
    code: str = "KEY_EXISTS"
    null_as: tuple[tuple[str, object], ...] = ()


Check = NotEmpty | Unique | NoNulls | SumsTo | NotInTarget


def _report(counted: DataFrame, table: str, entries: Sequence[tuple[str, str, bool]]) -> DataFrame:
    """Turn one row of counts into report rows; entries are (count column, code, zero is bad)."""
    rows = F.array(
        *[
            F.struct(
                ((F.col(c) == 0) if zero_bad else (F.col(c) > 0)).cast("int").alias("error_code"),
                F.lit(code).alias("error_abv"),
                F.lit(table).alias("error_table"),
                F.col(c).alias("row_cnt"),
            )
            for c, code, zero_bad in entries
        ]
    )
    return counted.select(F.inline(rows))


def check_report(df: DataFrame, checks: Sequence[Check], table: str) -> DataFrame:
    """Report (error_code, error_abv, error_table, row_cnt), one row per check."""
    in_pass = [c for c in checks if not isinstance(c, NotInTarget)]
    reports = []
    if in_pass:
        reports.append(_one_pass(df, in_pass, table))
    for c in checks:
        if isinstance(c, NotInTarget):
            hits = already_loaded(df, c.target, c.keys, dict(c.null_as)).agg(F.count(F.lit(1)).alias("n"))
            reports.append(_report(hits, table, [("n", c.code, False)]))
    return reduce(DataFrame.unionByName, reports)


def fingerprint(keys: Sequence[str]) -> tuple[Column, Column]:
    """128 bits that stand for a key: two hashes with different seeds over its columns and over which of them are NULL.

    Equal keys have equal fingerprints. That two of n different keys share one
    has a chance of n^2 / 2^129, below 10^-14 for a trillion keys.
    """
    unset = reduce(Column.__add__, [F.col(k).isNull().cast("long") * (1 << i) for i, k in enumerate(keys)])
    cols = [*[F.col(k) for k in keys], unset]
    return F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)


def _families(sets: Sequence[tuple[str, ...]]) -> dict[tuple[str, ...], list[tuple[str, ...]]]:
    """Key sets by the smallest set that each one contains; the first set's family comes first."""
    smallest = [s for s in sets if not any(set(o) < set(s) for o in sets)]
    found: dict[tuple[str, ...], list[tuple[str, ...]]] = {}
    for s in sets:
        root = next(o for o in sorted(smallest, key=len) if set(o) <= set(s))
        found.setdefault(root, []).append(s)
    return found


def _one_pass(df: DataFrame, checks: Sequence[Check], table: str) -> DataFrame:
    null_checks = [c for c in checks if isinstance(c, NoNulls)]
    grouped = [c for c in checks if isinstance(c, (Unique, SumsTo))]
    sets = list(dict.fromkeys(tuple(c.cols if isinstance(c, Unique) else c.keys) for c in grouped))
    null_row = {
        i: reduce(Column.__or__, [F.col(k).isNull() for k in c.cols]) for i, c in enumerate(null_checks)
    }

    entries, finals = [], []
    if not sets:
        for j, c in enumerate(checks):
            count = F.count(F.lit(1)) if isinstance(c, NotEmpty) else F.count_if(null_row[null_checks.index(c)])
            finals.append(count.alias(f"c{j}"))
            entries.append((f"c{j}", c.code, isinstance(c, NotEmpty)))
        return _report(df.agg(*finals), table, entries)

    amounts = list(dict.fromkeys(c.amount for c in grouped if isinstance(c, SumsTo)))
    summed = {(tuple(c.keys), c.amount) for c in grouped if isinstance(c, SumsTo)}
    nothing = F.lit(None)
    families = _families(sets)
    more = {root: sorted({k for s in members for k in s} - set(root)) for root, members in families.items()}
    added = sorted({k for keys in more.values() for k in keys})
    # One narrow row per family: the fingerprint of its smallest key, the columns of its larger ones, and what is summed.
    prepared = df.select(
        *[h.alias(f"{name}{f}") for f, root in enumerate(families) for name, h in zip("kl", fingerprint(root))],
        *[F.col(k).alias(f"c{i}") for i, k in enumerate(added)],
        *[money(a).alias(f"a{i}") for i, a in enumerate(amounts)],
        *[p.cast("long").alias(f"z{i}") for i, p in null_row.items()],
    )

    def kept(name: str, wanted: bool) -> Column:
        return (F.col(name) if wanted else nothing.cast(prepared.schema[name].dataType)).alias(name)

    rows = [
        F.struct(
            F.lit(f).alias("family"),
            F.col(f"k{f}").alias("k"),
            F.col(f"l{f}").alias("l"),
            *[kept(f"c{i}", k in more[root]) for i, k in enumerate(added)],
            *[kept(f"a{n}", any((s, a) in summed for s in members)) for n, a in enumerate(amounts)],
            *[kept(f"z{n}", f == 0) for n in null_row],
        )
        for f, (root, members) in enumerate(families.items())
    ]
    # Many parts: a task holds the keys of its part, and parts that Spark merges by their bytes would hold too many.
    parts = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = prepared.select(F.inline(F.array(*rows))).repartition(parts, "k", "l")

    # Behind the shuffle a row is counted for every set of its family: for the larger ones by a fingerprint of what they add.
    def copies(f: int, root: tuple[str, ...], members: list[tuple[str, ...]]) -> list[Column]:
        none = (F.lit(0).cast("long"), F.lit(0).cast("long"))
        return [
            F.struct(
                F.lit(sets.index(s)).alias("gid"),
                *[h.alias(name) for name, h in zip("ij", none if set(s) == set(root) else fingerprint([f"c{added.index(k)}" for k in s if k not in root]))],
                *[kept(f"a{n}", (s, a) in summed) for n, a in enumerate(amounts)],
                *[kept(f"z{n}", s == sets[0]) for n in null_row],
            )
            for s in members
        ]

    by_family = reduce(
        lambda rest, x: F.when(F.col("family") == x[0], F.array(*copies(x[0], *x[1]))).otherwise(rest), enumerate(families.items()), nothing
    )
    per_key = dealt.select("k", "l", F.inline(by_family)).groupBy("k", "l", "gid", "i", "j").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(f"a{i}").alias(f"a{i}") for i in range(len(amounts))],
        *[F.sum(f"z{i}").alias(f"z{i}") for i in null_row],
    )

    gid = {s: i for i, s in enumerate(sets)}.__getitem__
    first = F.col("gid") == 0
    for j, c in enumerate(checks):
        if isinstance(c, NotEmpty):
            count = F.sum(F.when(first, F.col("n")))
        elif isinstance(c, NoNulls):
            count = F.sum(F.when(first, F.col(f"z{null_checks.index(c)}")))
        elif isinstance(c, Unique):
            count = F.count_if((F.col("gid") == gid(tuple(c.cols))) & (F.col("n") > 1))
        else:
            total = F.round(F.col(f"a{amounts.index(c.amount)}"), 0)
            wrong = total > c.total if c.at_most else total != c.total
            count = F.count_if((F.col("gid") == gid(tuple(c.keys))) & wrong)
        finals.append(F.coalesce(count, F.lit(0)).cast("long").alias(f"c{j}"))
        entries.append((f"c{j}", c.code, isinstance(c, NotEmpty)))
    return _report(per_key.agg(*finals), table, entries)


# Rows of both sides that share a bucket of key marks, on average.
BUCKET_ROWS = 16_384
# Buckets that are looked at again are named in a filter; where there are more, the whole tables are.
MOST_BUCKETS = 4_096


def failed_checks(df: DataFrame, checks: Sequence[Check], table: str) -> list:
    """What ``failures(check_report(...))`` gives, collected; for stored tables, which are read several times.

    Runs jobs, one after the other, so that their shuffle files need not be on
    disk together. Keys that must not come again are first told apart by marks
    (``_doubtful``), 4 bytes a row on the way; only the buckets of marks in which
    a key may come twice go through the report, with all their rows.
    """
    found: list[tuple[int, object]] = []

    def report(rows: DataFrame, numbered: list[tuple[int, Check]]) -> None:
        """Entries come in the order of ``check_report``: checks against a target last."""
        ordered = sorted(numbered, key=lambda x: isinstance(x[1], NotInTarget))
        found.extend(zip([i for i, _ in ordered], check_report(rows, [c for _, c in ordered], table).collect()))

    numbered = list(enumerate(checks))
    if rest := [(i, c) for i, c in numbered if not isinstance(c, (Unique, NotInTarget))]:
        report(df, rest)
    unique = [(i, c) for i, c in numbered if isinstance(c, Unique)]
    n = df.count() if len(rest) < len(numbered) else 0
    for i, c in [x for x in numbered if isinstance(x[1], NotInTarget)]:
        with_it = [x for x in unique if tuple(x[1].cols) == tuple(c.keys)]
        unique = [x for x in unique if x not in with_it]
        rows, target = _doubtful(df, n, c.keys, bool(with_it), c.target, dict(c.null_as))
        if rows is not None:
            report(rows, [*with_it, (i, replace(c, target=target))])
    for cols in dict.fromkeys(tuple(c.cols) for _, c in unique):
        rows, _ = _doubtful(df, n, cols, True)
        if rows is not None:
            report(rows, [x for x in unique if tuple(x[1].cols) == cols])
    return [row for _, row in sorted(found, key=lambda x: x[0]) if row.error_code > 0]


def _doubtful(df: DataFrame, n: int, keys: Sequence[str], within: bool, target: DataFrame | None = None,
              null_as: Mapping[str, object] | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of ``df`` and of ``target`` whose key may come twice (``within``) in ``df`` or be in ``target``; (None, None) where there are none.

    A hash of the key is cut into a bucket and a mark of 32 bits. A task hands on
    the different marks of a bucket as one array, and a bucket is in doubt where
    ``df`` has fewer marks than rows, or a mark that ``target`` has as well.
    Equal keys have equal marks, so none is missed; different ones share a mark
    in about one bucket of 40. ``n`` is the number of rows of ``df``.
    """
    null_as = null_as or {}
    total = n + (target.count() if target is not None else 0)
    buckets = -(-total // BUCKET_ROWS) or 1

    def marks(frame: DataFrame, other: DataFrame) -> tuple[Column, Column]:
        def norm(f: DataFrame) -> list[Column]:
            return [F.coalesce(F.col(k), F.lit(null_as[k])) if k in null_as else F.col(k) for k in keys]

        types = [f.dataType for f in other.select(*[c.alias(f"_{i}") for i, c in enumerate(norm(other))]).schema]
        hashed = F.xxhash64(*[as_wide(c, t) for c, t in zip(norm(frame), types)])
        return F.pmod(hashed.bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(buckets)).cast("int"), F.shiftright(hashed, 32).cast("int")

    none = F.lit(None).cast("int")
    bucket, mark = marks(df, df if target is None else target)
    rows = df.select(bucket.alias("b"), mark.alias("n"), none.alias("t"))
    if target is not None:
        there, its = marks(target, df)
        rows = rows.unionAll(target.select(there.alias("b"), none.alias("n"), its.alias("t")))
    twice = F.size("n") < F.col("c") if within else F.lit(False)
    per_bucket = rows.groupBy("b").agg(F.count("n").alias("c"), F.collect_set("n").alias("n"), F.collect_set("t").alias("t"))
    doubt = [r.b for r in per_bucket.filter(twice | (F.size(F.array_intersect("n", "t")) > 0)).select("b").collect()]
    if not doubt:
        return None, None
    if len(doubt) > min(buckets // 8, MOST_BUCKETS):
        return df, target
    return df.filter(bucket.isin(doubt)), None if target is None else target.filter(there.isin(doubt))


def union_reports(*reports: DataFrame) -> DataFrame:
    """One report out of several."""
    return reduce(DataFrame.unionByName, reports)


def failures(report: DataFrame) -> DataFrame:
    """Failed checks only."""
    return report.filter(F.col("error_code") > 0)


class ChecksFailed(RuntimeError):
    def __init__(self, rows: list):
        self.rows = rows
        super().__init__("; ".join(f"{r.error_table}: {r.error_abv} ({r.row_cnt})" for r in rows))


def publish_if_clean(df: DataFrame, report: DataFrame, sink: Callable[[DataFrame], None],
                     raise_on_failure: bool = False) -> list:
    """Run ``sink(df)`` when no check failed; return the failed checks.

    The decision is made before anything is written, so a failed check leaves
    the target as it was. The report has one row per check.
    """
    failed = failures(report).collect()
    if not failed:
        sink(df)
    elif raise_on_failure:
        raise ChecksFailed(failed)
    return failed


# --- rules on records and fields ---------------------------------------------------


@dataclass(frozen=True)
class RecordRule:
    """A condition that makes a record wrong, with the field and text to report."""

    field: str
    description: str
    broken: Column


def row_errors(df: DataFrame, rules: Sequence[RecordRule], into: str = "errorDescription") -> DataFrame:
    """Add the array of (errorField, errorDesc) a row breaks; empty when clean."""
    return df.withColumn(into, _errors([(r, F.coalesce(r.broken, F.lit(False))) for r in rules]))


def _errors(flagged: Sequence[tuple[RecordRule, Column]]) -> Column:
    return present(
        [
            F.when(flag, F.struct(F.lit(r.field).alias("errorField"), F.lit(r.description).alias("errorDesc")))
            for r, flag in flagged
        ]
    )


def collect_errors(df: DataFrame, rules: Sequence[RecordRule], keys: Sequence[str], into: str = "errorDescription") -> DataFrame:
    """Distinct errors per key, in rule order; an empty array for clean keys.

    Each rule is one boolean per key, so nothing is collected.
    """
    flags = df.groupBy(*keys).agg(
        *[F.bool_or(F.coalesce(r.broken, F.lit(False))).alias(f"__r{i}") for i, r in enumerate(rules)]
    )
    return flags.select(*keys, _errors([(r, F.col(f"__r{i}")) for i, r in enumerate(rules)]).alias(into))


def first_error(df: DataFrame, rules: Sequence[RecordRule], keys: Sequence[str], into: str = "errorDescription") -> DataFrame:
    """The smallest error per key as a one-element array; empty for clean keys."""
    found = collect_errors(df, rules, keys, into)
    return found.withColumn(into, F.slice(F.array_sort(into), 1, 1))


@dataclass(frozen=True)
class FieldRule:
    """A condition that makes a field value wrong."""

    field: str
    column: str
    description: str
    broken: Column


def field_errors(df: DataFrame, rules: Sequence[FieldRule]) -> DataFrame:
    """One row (errorField, errorFieldValue, errorField_description) per wrong value, in one pass."""
    found = present(
        [
            F.when(
                F.coalesce(r.broken, F.lit(False)),
                F.struct(
                    F.lit(r.field).alias("errorField"),
                    F.col(r.column).cast("string").alias("errorFieldValue"),
                    F.lit(r.description).alias("errorField_description"),
                ),
            )
            for r in rules
        ]
    )
    return df.select(F.inline(found))


def starts_with_any(column: str | Column, firsts: Sequence[str]) -> Column:
    """True when the first character is one of ``firsts``."""
    return F.substring(column, 1, 1).isin(*firsts)


# --- framed files ----------------------------------------------------------------


def file_report(lines: DataFrame, max_records: int = 1_000_000, header: str = "HDR", trailer: str = "TRL",
                count_from: int = 25, count_length: int = 8) -> DataFrame:
    """One row per framed file: records, stated records and the list of issues.

    Tasks reduce their part of a file to its first line, last line and line
    count, so the size of a file does not matter.
    """
    per_file = lines.groupBy("file").agg(
        F.min_by("line", "at").alias("first_line"),
        F.max_by("line", "at").alias("last_line"),
        F.count(F.lit(1)).alias("lines"),
    )
    has_header = F.contains("first_line", F.lit(header))
    has_trailer = F.contains("last_line", F.lit(trailer))
    stated = F.trim(F.substring("last_line", count_from, count_length)).try_cast("long")
    records = F.col("lines") - 2
    same = F.coalesce(stated == records, F.lit(False))
    issues = present(
        [
            F.when(~has_trailer, F.lit("Trailer not found")),
            F.when(has_trailer & ~same, F.lit("Record count is not the same")),
            F.when(has_trailer & same & (records > max_records), F.lit("Record count is above the limit")),
            F.when(~has_header, F.lit("Header not found")),
        ]
    )
    return per_file.select(
        "file", records.alias("records"), F.when(has_trailer, stated).alias("stated_records"), issues.alias("issues")
    )
