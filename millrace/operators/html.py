"""Tables and elements of HTML pages."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Comments, raw-text elements and declarations, then tags, then text.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:script|style)\b.*?(?:</(?:script|style)\s*>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
    r"|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)

Cell = tuple[str, str | None]


def _table_rows(html: str) -> list[list[Cell]]:
    """Rows of (tag, text) cells of a page.

    A cell has a text when it, and each element inside it, has one single child;
    otherwise the text is None. A new cell or row closes an open one.
    """
    rows: list[list[Cell]] = []
    row: list[Cell] | None = None
    cell: str | None = None
    children, parts, single, in_text = [0], [], True, False

    def close_cell() -> None:
        nonlocal cell
        if cell is not None and row is not None:
            whole = single and all(n == 1 for n in children)
            row.append((cell, unescape("".join(parts)) if whole else None))
        cell = None

    def close_row() -> None:
        nonlocal row
        close_cell()
        if row:
            rows.append(row)
        row = None

    for token in _TOKEN.finditer(html):
        tag = token["tag"]
        if tag is None:
            if cell is not None and token["text"] is not None:
                children[-1] += not in_text
                parts.append(token["text"])
                in_text = True
            continue
        tag, in_text = tag.lower(), False
        if tag in ("td", "th"):
            close_cell()
            if not token["end"]:
                cell, children, parts, single = tag, [0], [], True
        elif tag == "tr" or (tag == "table" and token["end"]):
            close_row()
            row = [] if tag == "tr" and not token["end"] else None
        elif cell is not None and not token["end"]:
            children[-1] += 1
            children.append(0)
        elif cell is not None and len(children) > 1:
            single = children.pop() == 1 and single
    close_row()
    return rows


def _records(html: str, n_cols: int) -> Iterator[tuple[int, str | None, str | None]]:
    rows = _table_rows(html)
    names: list[str | None] = []
    for row in rows:
        heads = [text for tag, text in row if tag == "th"]
        if len(heads) == n_cols:
            names.extend(heads)
    number = 0
    for row in rows:
        values = [text for tag, text in row if tag == "td"]
        if len(values) == n_cols:
            number += 1
            for name, value in dict(zip(names, values)).items():
                yield number, name, value


def html_tables(df: DataFrame, key: str, html: str, n_cols: int) -> DataFrame:
    """Table cells of pages as rows (key, row, header, value).

    Headers are the cells of rows with exactly ``n_cols`` header cells; values
    come from rows with exactly ``n_cols`` data cells. Pages are parsed batch by
    batch inside the tasks; there is no shuffle.
    """
    schema = T.StructType(
        [
            df.schema[key],
            T.StructField("row", T.IntegerType()),
            T.StructField("header", T.StringType()),
            T.StructField("value", T.StringType()),
        ]
    )

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = [
                (page, *cell)
                for page, text in zip(batch[key], batch[html])
                if text is not None
                for cell in _records(text, n_cols)
            ]
            yield pd.DataFrame(cells, columns=schema.names)

    # Only pages that can hold a table reach Python.
    return df.select(key, html).filter(F.lower(html).contains("<td")).mapInPandas(parse, schema)


# What is no element, then one whole start tag: quoted values may hold any sign.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<![^>]*>"
_ATTRIBUTE = r"(?is)[\s\"'/]([^\s=\"'>/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?"
# All named references of HTML 5, and the numbers that it reads as other signs.
# They are looked up by their first two letters and then by name: a map is searched from its front.
_BY_START: dict[str, dict[str, str]] = {}
for _name, _char in html5.items():
    _BY_START.setdefault(_name[:2], {})[_name] = _char
REFERENCES = json.dumps(_BY_START)
_WINDOWS = {n: bytes([n]).decode("cp1252") for n in range(0x80, 0xA0) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def unescaped(c: Column) -> Column:
    """Decode decimal, hexadecimal and named references as in an attribute's value, each once.

    A name without ``;`` counts where HTML 5 lets it, unless a letter, digit or
    ``=`` follows. Numbers that are no character become U+FFFD.
    """
    names = F.from_json(F.lit(REFERENCES), "map<string,map<string,string>>")
    windows = F.create_map(*[F.lit(x) for pair in _WINDOWS.items() for x in pair])

    def number(piece: Column) -> Column:
        hexadecimal = F.regexp_extract(piece, r"^#[xX]0*([0-9A-Fa-f]{0,6})(?![0-9A-Fa-f])", 1)
        decimal = F.regexp_extract(piece, r"^#0*([0-9]{0,7})(?![0-9])", 1)
        code = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10).cast("int")).when(decimal != "", decimal.cast("int")).otherwise(0)
        real = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        # chr() knows single bytes only, so the character is built from UTF-32.
        char = F.when(real, F.coalesce(windows[code], F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")))
        return F.concat(F.coalesce(char, F.lit("\ufffd")), F.regexp_replace(piece, r"^#(?:[xX][0-9A-Fa-f]+|[0-9]+);?", ""))

    def named(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^[A-Za-z][A-Za-z0-9]*(?:;|(?![A-Za-z0-9=]))", 0)
        char = F.when(name == "", None).otherwise(names[F.left(name, F.lit(2))][name])
        return F.coalesce(F.concat(char, F.substr(piece, F.length(name) + 1)), F.concat(F.lit("&"), piece))

    def decoded(piece: Column) -> Column:
        amp = F.startswith(piece, F.lit("amp;"))
        return F.when(amp, F.concat(F.lit("&"), F.substr(piece, F.lit(5)))).when(
            piece.rlike(r"^#(?:[0-9]|[xX][0-9A-Fa-f])"), number(piece)).otherwise(named(piece))

    parts = F.split(c, "&")
    joined = F.array_join(F.transform(parts, lambda x, i: F.when(i == 0, x).otherwise(decoded(x))), "")
    return F.when(F.contains(c, F.lit("&")), joined).otherwise(c)


def attribute_values(html: str | Column, tag: str, attr: str) -> Column:
    """Array of the values of an attribute, over all elements of a tag.

    Comments, also open ones, scripts and styles hide what they hold. A tag is
    matched as a whole, with its quoted values, and its attributes are read from
    the front, so that neither ``>`` nor ``href=`` inside a value misleads. Of
    equal names in one tag the first counts. Character references are decoded.
    """
    # One scan finds what hides text and the tags; only a tag fills the group.
    found = F.regexp_extract_all(html, F.lit(rf"{HIDDEN}|<{tag}((?:\s|/)(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"), F.lit(1))
    tags = F.filter(found, lambda x: x != "")

    def first_value(inside: Column) -> Column:
        pairs = F.zip_with(
            F.regexp_extract_all(inside, F.lit(_ATTRIBUTE), F.lit(1)), F.regexp_extract_all(inside, F.lit(_ATTRIBUTE), F.lit(2)),
            lambda n, v: F.struct(F.lower(n).alias("n"), v.alias("v")),
        )
        # Most tags begin with the attribute that is asked for; the others are read from the front.
        ahead = F.regexp_extract(inside, rf"(?is)^\s+{re.escape(attr)}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1)
        return F.when(ahead != "", ahead).otherwise(F.get(F.filter(pairs, lambda x: x["n"] == attr.lower()), F.lit(0))["v"])

    values = F.filter(F.transform(tags, first_value), lambda v: v.isNotNull() & (v != ""))
    return F.transform(values, lambda v: unescaped(F.regexp_replace(v, r"(?s)^([\"'])(.*)\1$", "$2")))


def count_elements(df: DataFrame, html: str, tag: str, attr: str, length: int, by: list[str] | None = None,
                   name: str = "n") -> DataFrame:
    """Number of attribute lines of the given length, per page or in all.

    A value of several lines counts once for each line of that length. Counted
    inside each row; nothing is exploded.
    """
    lines = F.flatten(F.transform(attribute_values(html, tag, attr), lambda v: F.split(v, "\n")))
    hits = F.size(F.filter(lines, lambda v: F.length(v) == length))
    if by:
        return df.select(*by, hits.cast("long").alias(name))
    return df.agg(F.coalesce(F.sum(hits), F.lit(0)).cast("long").alias(name))
