"""Given tables written through the sinks and read back by the readers."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog import attribution as A
from millrace.catalog.registry import query
from millrace.functions.text import Field
from millrace.operators.quality import NoNulls, NotEmpty, Unique, check_report, file_report, publish_if_clean
from millrace.plans.loads import load_attribution
from millrace.session import ensure_checkpoint_dir
from millrace.sinks import files as out
from millrace.sinks import tables
from millrace.sources import files as src
from millrace.sources.streams import read_stream
from millrace.sources.tables import Tables, read_table
from millrace.streaming.ingest import run_stream, write_batch


def _folder(t: Tables) -> str:
    return f"{ensure_checkpoint_dir(t.spark)}/roundtrip-{uuid.uuid4().hex}"


def _table(*parts: str) -> list[str]:
    run = uuid.uuid4().hex
    return [f"rt_{run}_{p}" for p in parts]


ORDER = "o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate"
ORDER_DDL = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate STRING"


def _orders(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"),
    )


ORDER_SQL = ORDER.replace("CAST(o_orderdate AS VARCHAR)", "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)")


@query(f"SELECT {ORDER_SQL} FROM orders")
def roundtrip_orc_append(t: Tables) -> DataFrame:
    """Two appends to one ORC folder."""
    path, rows = _folder(t), _orders(t)
    out.append(rows.filter("o_orderkey % 2 = 0"), path)
    out.append(rows.filter("o_orderkey % 2 <> 0"), path)
    return t.spark.read.schema(ORDER_DDL).orc(path)


@query(f"SELECT {ORDER_SQL} FROM orders")
def roundtrip_publish(t: Tables) -> DataFrame:
    """A published folder replaces the one before."""
    path = _folder(t)
    out.publish(_orders(t).filter("o_orderkey % 2 = 0"), path, files=1)
    out.publish(_orders(t), path)
    return t.spark.read.schema(ORDER_DDL).parquet(path)


@query("SELECT doc_id, text IS NULL AS is_null, regexp_replace(coalesce(text, ''), '[\r\n]', ' ', 'g') AS line FROM documents")
def roundtrip_text_lines(t: Tables) -> DataFrame:
    """Texts as lines of a text file; what ends a line is a space there."""
    path = _folder(t)
    line = F.regexp_replace(F.coalesce("text", F.lit("")), "[\r\n]", " ")
    out.write_text(t.documents.select(F.concat(F.col("doc_id"), F.lit("|"), F.col("text").isNull(), F.lit("|"), line).alias("line")), "line", path)
    parts = F.split("value", r"\|", 3)
    return t.spark.read.text(path).select(
        parts[0].cast("bigint").alias("doc_id"), parts[1].cast("boolean").alias("is_null"), parts[2].alias("line")
    )


@query("SELECT event_id, user_id, event_type, props FROM events")
def roundtrip_json_lines(t: Tables) -> DataFrame:
    path = _folder(t)
    out.append(t.events.select("event_id", "user_id", "event_type", "props"), path, "json")
    return src.read_json(t.spark, path, "event_id BIGINT, user_id BIGINT, event_type STRING, props STRING")


@query("SELECT c_custkey, c_name, {'segment': c_mktsegment, 'nation': c_nationkey}.segment AS segment, c_nationkey AS nation FROM customer")
def roundtrip_json_nested(t: Tables) -> DataFrame:
    """A declared structure with a nested object; columns that it does not name are not read."""
    path = _folder(t)
    nested = F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    out.append(t.customer.select("c_custkey", "c_name", nested.alias("home"), F.lit(1).alias("other")), path, "json")
    ddl = src.as_struct("c_custkey BIGINT, c_name STRING, home STRUCT<segment: STRING, nation: INT>")
    return src.read_json(t.spark, path, ddl).select("c_custkey", "c_name", "home.segment", "home.nation")


@query(f"SELECT {ORDER_SQL} FROM orders")
def roundtrip_csv(t: Tables) -> DataFrame:
    path = _folder(t)
    _orders(t).write.csv(path)
    return src.read_csv(t.spark, path, ORDER_DDL)


@query(f"SELECT {ORDER_SQL} FROM orders")
def roundtrip_csv_header(t: Tables) -> DataFrame:
    path = _folder(t)
    _orders(t).write.option("header", True).csv(path, sep=";")
    return src.read_csv(t.spark, path, ORDER_DDL, sep=";", header=True)


PART_LINE = ("p_partkey", "p_name", "p_size")


@query("SELECT p_partkey, p_name || '|' || p_brand || chr(92) AS p_name, p_size, false AS rejected FROM part WHERE p_partkey % 10 <> 0 "
       "UNION ALL SELECT p_partkey, NULL, NULL, true FROM part WHERE p_partkey % 10 = 0")
def roundtrip_delimited(t: Tables) -> DataFrame:
    """Lines with escaped delimiters under a header, every tenth without its last fields: those are rejects."""
    path = _folder(t)
    name = F.concat("p_name", F.lit("|"), "p_brand", F.lit("\\"))
    escaped = F.regexp_replace(name, r"([\\|])", r"\\$1")
    whole = F.concat_ws("|", F.col("p_partkey").cast("string"), escaped, F.col("p_size").cast("string"))
    line = F.when(F.col("p_partkey") % 10 == 0, F.col("p_partkey").cast("string")).otherwise(whole)
    # A header in every file: the reader drops the first line of each.
    t.part.select(line.alias("key|name|size")).write.option("header", True).options(
        quote="", escape="", sep="\x01", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)
    rows, rejects = src.read_delimited(t.spark, path, "p_partkey BIGINT, p_name STRING, p_size INT", skip=1)
    return rows.withColumn("rejected", F.lit(False)).unionByName(
        rejects.select(
            F.col("line").cast("bigint").alias("p_partkey"), F.lit(None).cast("string").alias("p_name"),
            F.lit(None).cast("int").alias("p_size"), F.lit(True).alias("rejected"),
        )
    )


EBCDIC = [Field("c_custkey", 10, "right", "0"), Field("c_name", 25), Field("c_mktsegment", 12), Field("c_nationkey", 3, "right", " ")]


@query("SELECT c_custkey, rtrim(left(c_name, 25)) AS name, rtrim(left(c_mktsegment, 12)) AS segment, c_nationkey FROM customer")
def roundtrip_ebcdic(t: Tables) -> DataFrame:
    """Customers as EBCDIC records, read back record by record."""
    path = _folder(t)
    out.write_ebcdic(t.customer, EBCDIC, path)
    read = src.read_fixed_width(t.spark, path, [*[f.width for f in EBCDIC], 1], ["key", "name", "segment", "nation", ""], strip="ends")
    return read.select(F.col("key").cast("bigint").alias("c_custkey"), "name", "segment", F.col("nation").cast("int").alias("c_nationkey"))


@query("""
    SELECT o_custkey // 100 AS batch, count(*) AS records, count(*) AS stated_records, 0 AS n_issues
    FROM orders GROUP BY o_custkey // 100
""")
def roundtrip_framed(t: Tables) -> DataFrame:
    """Orders in framed files, one for every hundred customers: header, records, trailer with their number."""
    path = _folder(t)
    batch = F.floor(F.col("o_custkey") / 100).alias("batch")
    body = t.orders.select(batch, F.lit(1).alias("place"), F.concat(F.lit("REC"), F.col("o_orderkey")).alias("line"))
    ends = t.orders.groupBy(batch).agg(F.count(F.lit(1)).alias("n"))
    frame = F.array(
        F.struct(F.lit(0).alias("place"), F.lit("HDR").alias("line")),
        F.struct(F.lit(2).alias("place"), F.concat(F.rpad(F.lit("TRL"), 24, " "), F.lpad(F.col("n").cast("string"), 8, "0")).alias("line")),
    )
    lines = body.unionByName(ends.select("batch", F.inline(frame)))
    lines.repartition("batch").sortWithinPartitions("batch", "place").select("line", "batch").write.partitionBy("batch").text(path)
    report = file_report(src.read_framed(t.spark, path))
    return report.select(
        F.regexp_extract("file", r"batch=(\d+)", 1).cast("bigint").alias("batch"), "records", "stated_records", F.size("issues").alias("n_issues")
    )


@query(f"SELECT {ORDER_SQL}, CASE WHEN o_orderkey % 4 = 0 THEN 'created' WHEN o_orderkey % 4 = 1 THEN 'appended' ELSE 'inserted' END AS came FROM orders")
def roundtrip_tables(t: Tables) -> DataFrame:
    """One table made by CTAS, cloned, truncated, filled again by position, appended to, rewritten and read by name."""
    first, second = _table("first", "second")
    rows = _orders(t)
    part = lambda cond, came: rows.filter(cond).withColumn("came", F.lit(came))
    tables.create_as(part("o_orderkey % 4 = 0", "created"), first)
    tables.clone_empty(t.spark, first, second)
    tables.insert_into(part("o_orderkey % 4 = 3", "wrong"), second)
    tables.truncate(t.spark, second)
    tables.insert_into(part("o_orderkey % 4 > 1", "inserted"), second)
    tables.append(part("o_orderkey % 4 = 1", "appended"), second, ["came", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    tables.rewrite(read_table(t.spark, second).unionByName(read_table(t.spark, first)), first)
    tables.overwrite(rows.limit(0), second)
    tables.drop(t.spark, second)
    tables.analyze(t.spark, first, ["o_orderkey"])
    return read_table(t.spark, first)


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CASE WHEN year(o_orderdate) = 1996 THEN 2 ELSE 1 END AS version FROM orders")
def roundtrip_partitions(t: Tables) -> DataFrame:
    """A partitioned table of which one year is replaced, twice."""
    (name,) = _table("years")
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("y"))
    tables.overwrite_partitions(rows.withColumn("version", F.lit(1)), name, ["y"])
    for _ in range(2):
        tables.overwrite_partitions(rows.filter("y = 1996").withColumn("version", F.lit(2)), name, ["y"])
    return read_table(t.spark, name)


@query("SELECT c_custkey, c_name, 'published' AS state FROM customer UNION ALL SELECT -1, 'DUPLICATE_RECORDS', 'refused'")
def roundtrip_publish_if_clean(t: Tables) -> DataFrame:
    """Customers pass their checks and are published; twice the customers do not, and what is there stays."""
    path = _folder(t)
    rows = t.customer.select("c_custkey", "c_name", F.lit("published").alias("state"))
    checks = [NotEmpty(), Unique(("c_custkey",)), NoNulls(("c_custkey",))]
    publish_if_clean(rows, check_report(rows, checks, "customer"), lambda df: out.publish(df, path))
    twice = rows.unionAll(rows)
    failed = publish_if_clean(twice, check_report(twice, checks, "customer"), lambda df: out.publish(df, path))
    refused = t.spark.createDataFrame([(-1, r.error_abv, "refused") for r in failed], "c_custkey BIGINT, c_name STRING, state STRING")
    return t.spark.read.parquet(path).unionByName(refused)


@query("SELECT event_id, event_type FROM events")
def roundtrip_stream_restart(t: Tables) -> DataFrame:
    """A stream that is started again behind its checkpoint brings no event twice."""
    path = _folder(t)
    handle = lambda df, batch_id: write_batch(df.select("event_id", "event_type"), batch_id, f"{path}/out")
    for _ in range(2):
        source = read_stream(t.spark, "parquet", f"{t.folder}/event[s].parquet", t.events.schema)
        run_stream(source, handle, f"{path}/offsets", every=None).awaitTermination()
    return t.spark.read.orc(f"{path}/out").select("event_id", "event_type")


@query(
    A.FLAGGED_SQL.replace("l_partkey * 100000 + l_suppkey AS atrb_stay_key", "l_orderkey * 100000000000 + l_linenumber * 10000000000 + l_partkey * 100000 + l_suppkey AS atrb_stay_key")
    + " WHERE confo_num_orig_id % 50 <> 0"
)
def attribution_loaded(t: Tables) -> DataFrame:
    """Stays of two days loaded day by day, the second day twice: history stays as it was and nothing comes twice."""
    match, daily, audit = _table("match", "daily", "audit")
    # Keys of stays that no two days share, and the bookings whose shares add up.
    stays = A.stays(t).withColumn("atrb_stay_key", F.col("confo_num_orig_id") * 100_000_000_000 + F.col("confo_num_curr_id") * 10_000_000_000 + F.col("atrb_stay_key"))
    stays, shares = (x.filter(F.col("confo_num_orig_id") % 50 != 0) for x in (stays, A.allocations(t)))
    for day, rest in ((1, 0), (2, 1), (2, 1)):
        mine = F.col("confo_num_orig_id") % 2 == rest
        load_attribution(
            t.spark, stays.filter(mine), shares.filter(mine), A.agencies(t), match, daily, audit, "RT", dt.datetime(2024, 2, day, 3, 4, 5)
        )
    return A.shown(read_table(t.spark, match)).drop("load_dt")
