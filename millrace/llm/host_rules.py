"""Quality rules of documents and of the hosts they come from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import SPACE, group_key, text_or_empty, words, written

WINDOW = 8


@dataclass(frozen=True)
class Limits:
    """When a document fails.

    ``min_words`` and ``repeat_percent`` are the base rules. The others are soft:
    they count as failures of the host, and decide about a document only when
    its host is rejected.
    """

    min_words: int = 20
    repeat_percent: int = 30
    symbol_percent: int = 10
    dup_line_percent: int = 30
    word_chars: tuple[int, int] = (2, 15)
    host_rate: float = 0.5
    prior_strength: tuple[float, float] = (1.0, 1000.0)


def with_counts(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Add ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words``.

    All counts are of the whole text and made inside its row, so no text is
    shuffled. Repeated windows are found by 64-bit hashes of their words: a
    document without an equal pair, which is the usual case, costs one pass;
    only the others sort their windows. NULL counts as an empty text, for which
    every count is 0. Existing columns of these names are replaced.
    """
    p = prefix
    w, h, s = f"{p}__words", f"{p}__windows", f"{p}__sorted"
    t = text_or_empty(text)
    held = docs.withColumn(w, words(t))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    held = held.withColumns(
        {
            f"{p}n_words": F.size(w).cast("long"),
            f"{p}word_chars": F.length(F.regexp_replace(t, SPACE, "")).cast("long"),
            f"{p}n_symbols": (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("long"),
            f"{p}n_dup_lines": F.when(
                F.instr(t, "\n") > 0, (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")
            ).otherwise(F.lit(0).cast("long")),
            w: F.transform(w, lambda x: F.xxhash64(x)),
        }
    )
    held = held.withColumn(
        h,
        F.when(
            F.size(w) >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(w) - WINDOW),
                lambda i: F.xxhash64(*[F.get(F.col(w), i + k) for k in range(WINDOW)]),
            ),
        ),
    )
    held = held.withColumn(
        s,
        F.when(
            F.size(F.array_distinct(h)) < F.size(h),
            F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ),
    )

    def same(k, other):
        return F.coalesce(F.get(F.col(s), k)["h"] == F.get(F.col(s), other)["h"], F.lit(False))

    starts = F.array_sort(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: same(k, k - 1) | same(k, k + 1)),
            lambda k: F.get(F.col(s), k)["i"],
        )
    )
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, at: F.struct(
            (at + WINDOW).alias("end"), (a["n"] + at + WINDOW - F.greatest(at, a["end"])).alias("n")
        ),
        lambda a: a["n"].cast("long"),
    )
    held = held.withColumn(
        f"{p}n_repeat_words", F.when(F.col(s).isNotNull(), covered).otherwise(F.lit(0).cast("long"))
    )
    return held.drop(w, h, s)


def with_failures(counted: DataFrame, limits: Limits = Limits(), prefix: str = "") -> DataFrame:
    """Add ``base_failed`` and ``rule_failed`` (a base or a soft rule) from the counts."""
    c = {k: F.col(f"{prefix}{k}") for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    base = (c["n_words"] < limits.min_words) | (100 * c["n_repeat_words"] > limits.repeat_percent * c["n_words"])
    low, high = limits.word_chars
    soft = (
        (100 * c["n_symbols"] > limits.symbol_percent * c["word_chars"])
        | (100 * c["n_dup_lines"] > limits.dup_line_percent * c["n_words"])
        | (c["word_chars"] < low * c["n_words"])
        | (c["word_chars"] > high * c["n_words"])
    )
    return counted.withColumns({f"{prefix}base_failed": base, f"{prefix}rule_failed": base | soft})


def host_rates(rated: DataFrame, host: str, failed: str, limits: Limits = Limits()) -> DataFrame:
    """One row per host: ``host_key``, ``n_docs``, ``n_failed``, ``host_rate``, ``host_rejected``.

    Failures are counted before the shuffle, so a host with a third of all rows
    costs one row per task. The rates of all hosts give a beta prior by the
    method of moments, kept within ``prior_strength``; each host's rate is its
    posterior mean, so a host with a few documents is judged mostly by the
    prior. NULL is one host. The counts are written before the prior is taken
    from them, so the rows are read once; needs one job.
    """
    hosts = written(
        rated.groupBy(group_key(host).alias("host_key")).agg(
            F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col(failed)).alias("n_failed")
        )
    )
    rate = F.col("n_failed") / F.col("n_docs")
    low, high = limits.prior_strength
    prior = hosts.agg(F.struct(F.avg(rate).alias("m"), F.var_pop(rate).alias("v")).alias("p")).scalar()
    m, v = prior["m"], prior["v"]
    strength = F.when(v > 0, F.least(F.greatest(m * (1 - m) / v - 1, F.lit(low)), F.lit(high))).otherwise(F.lit(high))
    shrunk = (F.col("n_failed") + m * strength) / (F.col("n_docs") + strength)
    return hosts.withColumn("host_rate", shrunk).withColumn("host_rejected", F.col("host_rate") > limits.host_rate)


def host_verdicts(
    rated: DataFrame, host: str, limits: Limits = Limits(), prefix: str = "", write: bool = True
) -> DataFrame:
    """Add ``host_rate``, ``host_rejected`` and ``kept`` to the rows of ``with_failures``.

    A document that fails a base rule goes. In a rejected host every document
    that fails any rule goes too; documents without a failure stay wherever they
    come from. The rows are read for the rates and again for the verdicts: with
    ``write`` they are written once, which is cheaper for narrow rows; without
    it they are made twice, which saves the room for texts. The rates are joined
    back by host, split by AQE where a host is hot. An empty table gives an
    empty result.
    """
    p = prefix
    rows = rated.withColumn(f"{p}__host", group_key(host))
    rows = written(rows) if write else rows
    hosts = written(
        host_rates(rows, host, f"{p}rule_failed", limits).select(
            F.col("host_key").alias(f"{p}__key"),
            F.col("host_rate").alias(f"{p}host_rate"),
            F.col("host_rejected").alias(f"{p}host_rejected"),
        )
    )
    joined = rows.join(hosts, F.col(f"{p}__host") == F.col(f"{p}__key"), "left").drop(f"{p}__host", f"{p}__key")
    return joined.withColumn(
        f"{p}kept", ~F.col(f"{p}base_failed") & ~(F.col(f"{p}host_rejected") & F.col(f"{p}rule_failed"))
    )


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """Documents that the rules keep, with the columns they came with."""
    p = "__rules_"
    rated = with_failures(with_counts(docs, text, p), limits, p)
    # The flags leave a generator, and a filter on what a generator returns stays behind it: pushed
    # down to the scan it would hold the counts many times over, inside the loops of each other.
    flags = F.struct(F.col(f"{p}base_failed").alias("base"), F.col(f"{p}rule_failed").alias("rule"))
    rows = rated.select(*docs.columns, F.explode(F.array(flags)).alias(f"{p}flags")).select(
        *docs.columns, F.col(f"{p}flags.base").alias(f"{p}base_failed"), F.col(f"{p}flags.rule").alias(f"{p}rule_failed")
    )
    return host_verdicts(rows, host, limits, p, write=False).filter(F.col(f"{p}kept")).select(docs.columns)
