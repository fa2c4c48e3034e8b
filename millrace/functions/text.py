"""Text columns: profiles, cleaning, fixed-length records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The 32 ASCII punctuation marks as four character ranges, and
# the decimal digits of any script.
NO_WORD = r"[!-/:-@\[-`{-~\p{Nd}]+"


def blank(column: str | Column) -> Column:
    """True for NULL and for text with nothing but spaces."""
    c = F.col(column) if isinstance(column, str) else column
    return c.isNull() | (F.trim(c) == "")


def nth_word(column: str | Column, position: int, sep: str = " ") -> Column:
    """Zero-based word of a text; NULL when there are fewer words."""
    return F.get(F.split(column, sep), F.lit(position))


def clean_text(column: str | Column) -> Column:
    """Drop punctuation and digits, then lower-case."""
    return F.lower(F.regexp_replace(column, NO_WORD, ""))


def text_profile(df: DataFrame, column: str) -> DataFrame:
    """Add case forms, length, fixed slices and the second word of ``column``."""
    c = F.col(column)
    return df.withColumns(
        {
            f"{column}_upper": F.upper(c),
            f"{column}_lower": F.lower(c),
            f"{column}_initcap": F.initcap(c),
            f"{column}_length": F.length(c),
            f"{column}_first": F.substring(c, 1, 1),
            f"{column}_first3": F.left(c, F.lit(3)),
            f"{column}_last4": F.substring(c, -4, 4).try_cast("int"),
            f"{column}_from8": F.substring(c, 8, 4).try_cast("int"),
            f"{column}_word2": nth_word(c, 1),
        }
    )


@dataclass(frozen=True)
class Field:
    """One slot of a fixed-length record."""

    name: str
    width: int
    align: str = "left"
    fill: str = " "

    def render(self, null_as: str | None) -> Column:
        text = F.col(self.name).cast("string")
        if null_as is not None:
            text = F.coalesce(text, F.lit(null_as))
        pad = F.lpad if self.align == "right" else F.rpad
        return pad(text, self.width, self.fill)


def fixed_record(fields: Sequence[Field], null_as: str | None = "") -> Column:
    """Concatenate padded fields; longer values are cut to the field width.

    With ``null_as=None`` one NULL field makes the whole record NULL, which is
    what plain ``concat`` does.
    """
    return F.concat(*[f.render(null_as) for f in fields])


def slice_record(column: str | Column, widths: Sequence[int], names: Sequence[str]) -> list[Column]:
    """Cut a fixed-length text into named columns."""
    if len(widths) != len(names):
        raise ValueError("one name per width is needed")
    out, start = [], 1
    for width, name in zip(widths, names):
        out.append(F.substring(column, start, width).alias(name))
        start += width
    return out
