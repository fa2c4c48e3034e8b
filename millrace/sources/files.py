"""Readers for files: JSON lines, delimited, fixed-width, framed text."""

from __future__ import annotations

import re
import codecs
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import slice_record

CORRUPT = "_corrupt_record"


def as_struct(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_json(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines with a declared schema; nothing is inferred."""
    return spark.read.schema(as_struct(schema)).json(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",", header: bool = False,
             **options: str) -> DataFrame:
    """Plain CSV with a declared schema."""
    return spark.read.schema(as_struct(schema)).options(**options).csv(path, sep=sep, header=header)


# --- JSON text with quarantine -------------------------------------------------


def parse_json(df: DataFrame, column: str, schema: str | T.StructType, into: str = "message",
               corrupt: str = CORRUPT) -> DataFrame:
    """Parse a JSON text column; rows that do not parse keep their text in ``corrupt``.

    Works on batch and streaming frames alike. Blank lines count as corrupt.
    """
    schema = as_struct(schema)
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField("__corrupt", T.StringType())])
    raw = F.from_json(column, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"})
    # A filter on a projected column is pushed below the projection together with
    # the expression, which would parse every text again for each use. Filters
    # do not pass a generator, so a one-element array keeps it at one parse.
    parsed = df.select("*", F.explode(F.array(raw)).alias("__raw"))
    good = F.struct(*[F.col("__raw").getField(f.name).alias(f.name) for f in schema.fields])
    is_bad = F.col("__raw").isNull() | F.col("__raw.__corrupt").isNotNull()
    return parsed.select(
        *[c for c in df.columns if c not in (into, corrupt)],
        F.when(is_bad, F.coalesce(F.col(column), F.lit(""))).alias(corrupt),
        F.when(~is_bad, good).alias(into),
    )


def quarantine(df: DataFrame, corrupt: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """Split parsed rows into (good, bad) on the corrupt column."""
    return df.filter(F.col(corrupt).isNull()).drop(corrupt), df.filter(F.col(corrupt).isNotNull())


def corrupt_counts(df: DataFrame, corrupt: str = CORRUPT) -> DataFrame:
    """One row: messages in, good, corrupt."""
    bad = F.col(corrupt).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(~bad).alias("good"),
        F.count_if(bad).alias("corrupt"),
    )


# --- delimited with an escaped delimiter ---------------------------------------


def _lines(spark: SparkSession, path: str, skip: int) -> DataFrame:
    if skip == 0:
        return spark.read.text(path).filter(F.trim("value") != "").select("value", "_metadata")
    if skip == 1:
        # The CSV reader is the one reader that drops the first line of every
        # file while still splitting large files. A separator that is no
        # character (U+FFFF) makes each line a single field; a line that holds
        # it all the same has too many fields, and such lines are kept whole.
        lines = spark.read.schema("value STRING, whole STRING").csv(
            path, sep="\uffff", quote="", header=True, enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord="whole",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, maxCharsPerColumn=-1,
        )
        return lines.select(F.coalesce("whole", "value").alias("value"), "_metadata")
    raise ValueError("only 0 or 1 header lines can be skipped")


def split_escaped(line: str | Column, sep: str = "|", escape: str = "\\") -> Column:
    """Split on delimiters that are not escaped, then remove the escapes.

    The line is read from left to right: an escape character takes the character
    behind it along, however many stand in a row. A single escape at the end of
    the line stands for itself.
    """
    c = F.col(line) if isinstance(line, str) else line
    e, s = re.escape(escape), re.escape(sep)
    # Every field, also the last one, ends with a delimiter. A lone escape at the
    # end is doubled first, or it would hide that delimiter.
    lone = c.rlike(rf"(?s)\A(?:[^{e}]|{e}.)*+{e}\z")
    closed = F.concat(F.when(lone, F.concat(c, F.lit(escape))).otherwise(c), F.lit(sep))
    fields = F.regexp_extract_all(closed, F.lit(rf"(?s)((?:[^{e}{s}]++|{e}.)*+){s}"), F.lit(1))
    return F.transform(fields, lambda f: F.regexp_replace(f, rf"(?s){e}(.)", "$1"))


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    sep: str = "|",
    skip: int = 0,
    escape: str = "\\",
    date_format: str = "yyyy-MM-dd",
) -> tuple[DataFrame, DataFrame]:
    """Bulk-load reader: (rows, rejects).

    Extra fields are ignored. A line is rejected when it has too few fields or
    when a non-empty field cannot be read as its type. Empty fields are NULL,
    blank lines are ignored.
    """
    schema = as_struct(schema)
    fields = split_escaped("value", sep, escape)
    raw = _lines(spark, path, skip).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), fields.alias("f")
    )

    def value(i: int, kind: T.DataType) -> Column:
        text = F.nullif(F.get("f", F.lit(i)), F.lit(""))
        if isinstance(kind, T.StringType):
            return text
        if isinstance(kind, T.DateType):
            return F.try_to_date(text, date_format)
        return F.trim(text).try_cast(kind)

    typed = raw.select(
        "line", "file", "f", *[value(i, f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    )
    unreadable = F.lit(False)
    for i, f in enumerate(schema.fields):
        if not isinstance(f.dataType, T.StringType):
            unreadable = unreadable | (F.col(f.name).isNull() & (F.get("f", F.lit(i)) != ""))
    reason = (
        F.when(F.size("f") < len(schema.fields), "too few fields")
        .when(F.coalesce(unreadable, F.lit(False)), "unreadable value")
    )
    typed = typed.withColumn("reason", reason)
    rows = typed.filter(F.col("reason").isNull()).select(*[f.name for f in schema.fields])
    rejects = typed.filter(F.col("reason").isNotNull()).select("file", "line", "reason")
    return rows, rejects


class RejectLimitExceeded(RuntimeError):
    pass


def enforce_reject_limit(rejects: DataFrame, max_rejects: int = 0, path: str | None = None) -> int:
    """Write the rejected lines, then fail when there are too many. Runs a job.

    Each call writes a folder of its own (``load_id`` is a partition column for
    readers), and the count comes from the files just written.
    """
    if path:
        folder = f"{path}/load_id={uuid.uuid4()}"
        rejects.write.parquet(folder)
        rejects = rejects.sparkSession.read.schema(rejects.schema).parquet(folder)
    n = rejects.count()
    if n > max_rejects:
        raise RejectLimitExceeded(f"{n} rejected lines, {max_rejects} allowed")
    return n


# --- fixed-width mainframe records ---------------------------------------------


def _code_page(name: str) -> tuple[str, str]:
    """Bytes as ISO-8859-1 characters, and the characters that a code page gives them, where both differ."""
    table = bytes(range(256))
    pairs = [(s, t) for s, t in zip(table.decode("iso-8859-1"), codecs.decode(table, name)) if s != t and s != "\x00"]
    return "".join(s for s, _ in pairs), "".join(t for _, t in pairs)


def decode_ebcdic(column: str | Column, code_page: str = "cp037") -> Column:
    """EBCDIC bytes to text, inside the JVM.

    The bytes are read one-to-one as ISO-8859-1 and translated with a map that
    comes from the code page itself.
    """
    return F.translate(F.decode(column, "ISO-8859-1"), *_code_page(code_page))


def encode_ebcdic(column: str | Column, code_page: str = "cp037") -> Column:
    """Text to EBCDIC bytes, inside the JVM; ``decode_ebcdic`` the other way round."""
    shown, meant = _code_page(code_page)
    return F.encode(F.translate(column, meant, shown), "ISO-8859-1")


def read_records(spark: SparkSession, path: str, length: int) -> DataFrame:
    """Column ``record``: the files of ``path`` cut every ``length`` bytes.

    Large files are split between records and read by many tasks, from any store
    that Spark reads. The bytes become a Dataset inside the JVM, so no record
    passes through Python. A file that is no whole number of records fails.
    """
    found = spark.sparkContext._jsc.sc().binaryRecords(path, length, spark._jsc.hadoopConfiguration())
    binary = spark._jvm.org.apache.spark.sql.Encoders.BINARY()
    return DataFrame(spark._jsparkSession.createDataset(found, binary).toDF(), spark).withColumnRenamed("value", "record")


def read_fixed_width(
    spark: SparkSession,
    path: str,
    widths: Sequence[int],
    names: Sequence[str],
    encoding: str = "ebcdic",
    strip: str = "all",
    code_page: str = "cp037",
) -> DataFrame:
    """Records of equal length without line ends.

    A large file is split at record boundaries and read by many tasks; a slot
    named "" is skipped. ``strip`` removes all blanks and tabs (also inside a
    value), only those at the ends, or none.
    """
    raw = read_records(spark, path, sum(widths))
    if encoding == "ebcdic":
        text = decode_ebcdic("record", code_page)
    else:
        text = F.decode("record", encoding)
    slots = [c for c, n in zip(slice_record("record", widths, names), names) if n]
    sliced = raw.select(text.alias("record")).select(*slots)
    if strip == "all":
        clean = {n: F.regexp_replace(n, r"[ \t]", "") for n in names if n}
    elif strip == "ends":
        clean = {n: F.trim(F.col(n)) for n in names if n}
    elif strip == "none":
        return sliced
    else:
        raise ValueError(f"unknown strip mode: {strip}")
    return sliced.withColumns(clean)


# --- framed text -----------------------------------------------------------------


def read_framed(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their file and a position that orders the lines of a file.

    ``at`` is (start of the file block, running number inside the task): blocks
    of one file may be read by different tasks, lines of one block never are.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("line_no"),
        ).alias("at"),
        F.col("value").alias("line"),
    )
