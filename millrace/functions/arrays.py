"""Array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def element_or(array: str | Column, index: int, fallback: int) -> Column:
    """Element ``index``, else element ``fallback``; NULL when both are missing."""
    return F.coalesce(F.get(array, F.lit(index)), F.get(array, F.lit(fallback)))


def repeat_counted(counted: str | Column, value: str, n: str = "n") -> Column:
    """Turn an array of (value, count) structs into the plain list it stands for."""
    return F.flatten(F.transform(counted, lambda e: F.array_repeat(e[value], e[n].cast("int"))))
