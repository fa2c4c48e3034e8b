"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*columns: str | Column, algo: str = "md5", sep: str = "|", null_as: str = "") -> Column:
    """Hash key of one or more values.

    The parts are joined with a separator so that (1, 23) and (12, 3) differ.
    ``md5`` and ``sha2`` are text keys for stored tables; ``xxhash64`` is a
    64-bit key that will collide on very large tables.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    if algo == "xxhash64":
        return F.xxhash64(*cols)
    text = F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit(null_as)) for c in cols])
    if algo == "md5":
        return F.md5(text)
    if algo == "sha2":
        return F.sha2(text, 256)
    raise ValueError(f"unknown key algorithm: {algo}")
