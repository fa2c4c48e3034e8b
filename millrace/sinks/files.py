"""Writers to files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import Field, fixed_record
from millrace.sources.files import encode_ebcdic


def append(df: DataFrame, path: str, fmt: str = "orc") -> None:
    df.write.mode("append").format(fmt).save(path)


def publish(df: DataFrame, path: str, files: int | None = None, compression: str = "none", fmt: str = "parquet") -> None:
    """Overwrite a folder with as few files as the size of the result asks for.

    Rows are rebalanced by measured bytes: partitions are merged or split until
    each is near ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so a
    report is one file and a large result as many as it needs, whatever the
    number of tasks before. ``files`` fixes the number instead, for readers
    that want exactly so many; give it only to results that so many tasks hold.
    """
    out = df.hint("rebalance") if files is None else df.repartition(files)
    out.write.mode("overwrite").option("compression", compression).format(fmt).save(path)


def write_text(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("append").text(path)


def write_fixed_width(df: DataFrame, fields: Sequence[Field], path: str, null_as: str = "") -> None:
    """Fixed-length text records, one per line."""
    df.select(fixed_record(fields, null_as).alias("value")).write.mode("overwrite").text(path)


def write_ebcdic(df: DataFrame, fields: Sequence[Field], path: str, null_as: str = "", code_page: str = "cp037") -> None:
    """Fixed-length records in EBCDIC, each followed by a line feed byte.

    A reader takes the line feed as one more slot of width 1. Values must be
    characters of the code page.
    """
    image = F.decode(encode_ebcdic(fixed_record(fields, null_as), code_page), "ISO-8859-1")
    # Bytes go out as ISO-8859-1 characters; nothing in a record may be quoted, escaped or trimmed.
    df.select(image.alias("record")).write.mode("overwrite").options(
        encoding="ISO-8859-1", quote="", escape="", sep="\x01", lineSep="\n", emptyValue="", charToEscapeQuoteEscaping="",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    ).csv(path)
