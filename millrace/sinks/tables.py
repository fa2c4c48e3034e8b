"""Writers to metastore tables.

Plain Parquet and ORC tables have no transactions. A table that is also read
by its own rewrite is written under a second name and swapped in; one writer
per table is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import CLEANUP, setting

# Text keys such as md5 take half the space that the default codec gives them.
CODEC = ("spark.sql.parquet.compression.codec", "zstd")
# Rows that all go to one partition are not sorted by it before they are written.
UNSORTED = ("spark.sql.maxConcurrentOutputFileWriters", "2")


def overwrite(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).saveAsTable(table)


def append(df: DataFrame, table: str, columns: Sequence[str] | None = None, fmt: str = "parquet") -> None:
    """Append by name; columns the frame lacks become NULL.

    The table is created when it does not exist; a swap of it that stopped half
    way is undone first, so that its history is not lost.
    """
    out = df.select(*columns) if columns else df
    recover(out.sparkSession, table)
    if not out.sparkSession.catalog.tableExists(table):
        out.write.format(fmt).saveAsTable(table)
        return
    target = out.sparkSession.table(table).schema
    out.select(
        *[F.col(f.name) if f.name in out.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in target]
    ).write.insertInto(table)


def create_as(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """CREATE TABLE AS SELECT; fails when the table exists."""
    df.write.mode("errorifexists").format(fmt).saveAsTable(table)


def insert_into(df: DataFrame, table: str, overwrite: bool = True) -> None:
    """Insert by position into an existing table."""
    df.write.insertInto(table, overwrite=overwrite)


def clone_empty(spark: SparkSession, source: str, target: str, fmt: str = "parquet") -> None:
    """New empty table with the columns of another one."""
    spark.table(source).limit(0).write.mode("errorifexists").format(fmt).saveAsTable(target)


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


# Property of a rebuilt table whose rows are all written.
COMPLETE = "millrace.complete"


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    """Table properties that a user set; those that Spark keeps for itself are left out."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    own = ("spark.", "transient_", "numFiles", "totalSize", "numRows", "rawDataSize", "view.", "option.", COMPLETE)
    return {r["key"]: r["value"] for r in rows if not r["key"].startswith(own)}


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _set_properties(spark: SparkSession, table: str, values: dict[str, str]) -> None:
    if values:
        quoted = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in values.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({quoted})")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _is_complete(spark: SparkSession, table: str) -> bool:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return any(r["key"] == COMPLETE and r["value"] == "true" for r in rows)


def recover(spark: SparkSession, final: str) -> None:
    """Finish or undo a swap that stopped half way.

    Where ``final`` is missing, a rebuilt table whose rows are all written takes
    its place; otherwise the old version gets its name back. Where ``final`` is
    there and was not renamed last nothing changes.
    """
    rebuilt, old = f"{final}__next", f"{final}__old"
    if spark.catalog.tableExists(final):
        if _is_complete(spark, final):
            _finish(spark, final)
    elif spark.catalog.tableExists(rebuilt) and _is_complete(spark, rebuilt):
        if spark.catalog.tableExists(old):
            _repair(spark, old)
        spark.sql(f"ALTER TABLE {rebuilt} RENAME TO {final}")
        _finish(spark, final)
    elif spark.catalog.tableExists(old):
        spark.sql(f"ALTER TABLE {old} RENAME TO {final}")
        _finish(spark, final)


def _repair(spark: SparkSession, renamed: str) -> None:
    """Let the catalog find the partitions of a renamed table.

    Some catalogs leave them at the places they had under the old name, where
    another table stands next: dropping the renamed one would delete its files.
    """
    if partition_columns(spark, renamed):
        spark.sql(f"MSCK REPAIR TABLE {renamed} SYNC PARTITIONS")


def _finish(spark: SparkSession, final: str) -> None:
    """After a rename: partitions found under the new name, the old version dropped, the mark taken off."""
    _repair(spark, final)
    drop(spark, f"{final}__old")
    spark.sql(f"ALTER TABLE {final} UNSET TBLPROPERTIES IF EXISTS ('{COMPLETE}')")


def swap(spark: SparkSession, rebuilt: str, final: str) -> None:
    """Put a rebuilt table in the place of ``final``.

    Both are marked as whole before they are renamed, and the old version is
    dropped last: a failure in between leaves a whole version on disk, and
    ``recover`` ends or undoes the swap.
    """
    _set_properties(spark, rebuilt, {COMPLETE: "true"})
    if spark.catalog.tableExists(final):
        old = f"{final}__old"
        drop(spark, old)
        _set_properties(spark, final, {COMPLETE: "true"})
        spark.sql(f"ALTER TABLE {final} RENAME TO {old}")
        _repair(spark, old)
    spark.sql(f"ALTER TABLE {rebuilt} RENAME TO {final}")
    _finish(spark, final)


def rewrite(df: DataFrame, table: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None) -> None:
    """Replace ``table`` with ``df``, which may itself read ``table``.

    The new version has the partition columns and the properties that the old
    one has in the catalog, unless ``partition_by`` names others; partition
    columns that ``df`` lacks are left out. A swap that stopped half way is
    ended or undone first.
    """
    spark = df.sparkSession
    recover(spark, table)
    rebuilt = f"{table}__next"
    kept: dict[str, str] = {}
    parts = list(partition_by or [])
    if spark.catalog.tableExists(table):
        kept = properties(spark, table)
        if partition_by is None:
            parts = [c for c in partition_columns(spark, table) if c in df.columns]
    drop(spark, rebuilt)
    writer = df.write.format(fmt)
    with setting(spark, *CODEC), setting(spark, *CLEANUP):
        (writer.partitionBy(*parts) if parts else writer).saveAsTable(rebuilt)
    _set_properties(spark, rebuilt, kept)
    swap(spark, rebuilt, table)


def overwrite_partitions(df: DataFrame, table: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace the partitions of ``table`` that ``df`` has rows of; all others keep their files.

    Writing the same rows again leaves the table as it is, so a load that was
    stopped or repeated adds nothing. The rows are written beside the table and
    moved in when all of them are there. The table is created when it does not
    exist; columns that ``df`` lacks become NULL. A table with other partition
    columns is refused: a whole rewrite would be needed.
    """
    spark = df.sparkSession
    recover(spark, table)
    if not spark.catalog.tableExists(table):
        with setting(spark, *CODEC), setting(spark, *CLEANUP), setting(spark, *UNSORTED):
            df.write.format(fmt).partitionBy(*partition_by).saveAsTable(table)
        return
    if partition_columns(spark, table) != list(partition_by):
        raise ValueError(f"{table} is partitioned by {partition_columns(spark, table)}, not by {list(partition_by)}")
    target = spark.table(table).schema
    out = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in target])
    # Inserts read the session alone.
    with setting(spark, *CODEC), setting(spark, *CLEANUP), setting(spark, *UNSORTED), setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        out.write.insertInto(table, overwrite=True)


def analyze(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> None:
    """Refresh statistics, which the optimizer needs to choose join sides."""
    extra = f" FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{extra}")
