import codecs

import pytest
from pyspark.sql import functions as F

from millrace.functions.text import Field
from millrace.operators.quality import file_report
from millrace.plans.loads import REJECT_LAYOUT, convert_rejects
from millrace.sinks.files import write_fixed_width
from millrace.sources import files, streams, tables


def put(path, text):
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_json_with_ddl_schema(spark, tmp_path):
    p = put(tmp_path / "e.json", '{"event_id": 1, "event_date": "2024-01-02T03:04:05", "event_status": "CLOSED", "x": 1}\n')
    df = files.read_json(spark, p, "event_id INT, event_date TIMESTAMP, event_reference_id INT, event_status STRING")
    row = df.first()
    assert df.columns == ["event_id", "event_date", "event_reference_id", "event_status"]
    assert row.event_id == 1 and row.event_reference_id is None and row.event_date.year == 2024


def test_csv_with_and_without_header(spark, tmp_path):
    a = put(tmp_path / "a.csv", "1,2024-01-02\n2,2024-01-03\n")
    b = put(tmp_path / "b.csv", "id,d\n1,2024-01-02\n")
    assert files.read_csv(spark, a, "id INT, d DATE").count() == 2
    assert files.read_csv(spark, b, "id INT, d DATE", header=True).first().id == 1


def test_trap_1_corrupt_rows_alone(spark):
    raw = spark.createDataFrame([('{"a": 1}',), ('{"a": ',), ("",), (None,), ('{"a": "x"}',)], "value STRING")
    parsed = files.parse_json(raw, "value", "a INT")
    good, bad = files.quarantine(parsed)
    assert [r.message.a for r in good.collect()] == [1]
    assert sorted(r[0] for r in bad.select("_corrupt_record").collect()) == ["", "", '{"a": ', '{"a": "x"}']
    assert tuple(files.corrupt_counts(parsed).first()) == (5, 1, 4)


BULK = (
    "CODE|DESC|QTY|DAY\n"
    "A1|plain|3|2024-01-02\n"
    "A2|with \\| pipe|4|2024-01-03|extra|fields\n"
    "A3|back\\\\|5|\n"
    "A4|short\n"
    "A5|bad date|6|2024-13-40\n"
    "A6|bad number|x|2024-01-02\n"
    "A7||7|2024-01-05\n"
)
SCHEMA = "code STRING, desc STRING, qty INT, day DATE"


def test_trap_2_escaped_delimiter_and_rejects(spark, tmp_path):
    p = put(tmp_path / "bulk.txt", BULK)
    rows, rejects = files.read_delimited(spark, p, SCHEMA, skip=1)
    got = {r.code: r for r in rows.collect()}
    assert sorted(got) == ["A1", "A2", "A3", "A7"]
    assert got["A2"].desc == "with | pipe" and got["A3"].desc == "back\\"
    assert got["A3"].day is None and got["A7"].desc is None
    assert {r.line.split("|")[0]: r.reason for r in rejects.collect()} == {
        "A4": "too few fields", "A5": "unreadable value", "A6": "unreadable value",
    }


def test_every_file_loses_its_own_header(spark, tmp_path):
    for i in range(3):
        put(tmp_path / f"f{i}.txt", f"H|H|H|H\n{i}|a|1|2024-01-01\n")
    rows, rejects = files.read_delimited(spark, str(tmp_path), SCHEMA, skip=1)
    assert sorted(r.code for r in rows.collect()) == ["0", "1", "2"] and rejects.count() == 0
    plain, _ = files.read_delimited(spark, str(tmp_path), "a STRING, b STRING")
    assert plain.count() == 6
    with pytest.raises(ValueError):
        files.read_delimited(spark, str(tmp_path), SCHEMA, skip=2)


def test_reject_limit(spark, tmp_path):
    p = put(tmp_path / "bulk.txt", BULK)
    _, rejects = files.read_delimited(spark, p, SCHEMA, skip=1)
    out = str(tmp_path / "rejects")
    with pytest.raises(files.RejectLimitExceeded):
        files.enforce_reject_limit(rejects, 0, out)
    assert spark.read.parquet(out).count() == 3
    assert files.enforce_reject_limit(rejects, 3) == 3


def reject_record(**values):
    text = "".join(str(values.get(n, "")).ljust(w)[:w] for n, w in REJECT_LAYOUT.items())
    return codecs.encode(text, "cp037")


def test_trap_3_fixed_width_ebcdic(spark, tmp_path):
    assert sum(REJECT_LAYOUT.values()) == 171 and len(REJECT_LAYOUT) == 33
    data = reject_record(dtl_rec_type="DTL", property_cd="N Y", arrival_dt="2024-01-02", percentage="09960") + reject_record(
        dtl_rec_type="DTL", sequence_num="2", arrival_dt="bad", percentage="x", reject_reason_cd_20="E20"
    )
    p = put(tmp_path / "rejects.bin", data)
    raw = files.read_fixed_width(spark, p, list(REJECT_LAYOUT.values()), list(REJECT_LAYOUT))
    a, b = convert_rejects(raw).orderBy("sequence_num").collect()
    assert a.property_cd == "NY" and str(a.percentage) == "99.60" and str(a.arrival_dt) == "2024-01-02"
    assert b.arrival_dt is None and b.percentage is None and b.reject_reason_cd_20 == "E20"
    ends = files.read_fixed_width(spark, p, list(REJECT_LAYOUT.values()), list(REJECT_LAYOUT), strip="ends")
    assert "N Y" in [r.property_cd for r in ends.collect()]


def test_code_page_covers_printable_characters(spark):
    text = "".join(chr(c) for c in range(32, 127))
    df = spark.createDataFrame([(bytearray(codecs.encode(text, "cp037")),)], "b BINARY")
    assert df.select(files.decode_ebcdic("b")).first()[0] == text


def test_fixed_width_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 7), (None, 12)], "name STRING, n INT")
    fields = [Field("name", 4), Field("n", 3, "right", "0")]
    write_fixed_width(df, fields, str(tmp_path / "out"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert lines == ["    012", "a   007"]


def framed(records, stated=None, header="HDR", trailer="TRL"):
    body = [f"R{i}" for i in range(records)]
    last = f"{trailer}{'':21}{records if stated is None else stated:08d}"
    return "\n".join([f"{header} 20240102", *body, last]) + "\n"


def test_trap_25_framed_files(spark, tmp_path):
    put(tmp_path / "ok.txt", framed(3))
    put(tmp_path / "count.txt", framed(3, 4))
    put(tmp_path / "nohdr.txt", framed(2, header="XXX"))
    put(tmp_path / "notrl.txt", framed(2, trailer="XXX"))
    put(tmp_path / "large.txt", framed(20))
    report = file_report(files.read_framed(spark, str(tmp_path)), max_records=10)
    got = {r.file.rsplit("/", 1)[1]: (r.records, r.issues) for r in report.collect()}
    assert got == {
        "ok.txt": (3, []),
        "count.txt": (3, ["Record count is not the same"]),
        "nohdr.txt": (2, ["Header not found"]),
        "notrl.txt": (2, ["Trailer not found"]),
        "large.txt": (20, ["Record count is above the limit"]),
    }


def test_framed_file_read_by_several_tasks(spark, tmp_path):
    put(tmp_path / "big.txt", framed(30000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = files.read_framed(spark, str(tmp_path / "big.txt"))
        assert lines.rdd.getNumPartitions() > 4
        row = file_report(lines).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert row.records == row.stated_records == 30000 and row.issues == []


def test_jdbc_options():
    one = tables.jdbc_options("jdbc:x", "t")
    assert "numPartitions" not in one
    many = tables.jdbc_options("jdbc:x", "t", "id", ("1", "100"), 8)
    assert many["numPartitions"] == "8" and many["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "t", n=4)
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "t", "id")


def test_kafka_options():
    assert streams.kafka_options("h:1", "topic", "earliest")["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        streams.kafka_options("h:1", "topic", "smallest")


def test_metastore_table(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("src_read_me")
    assert tables.read_table(spark, "src_read_me").agg(F.sum("id")).first()[0] == 3


def test_quotes_and_blank_lines_are_plain(spark, tmp_path):
    p = put(tmp_path / "q.txt", 'H|H\n"a|b"\n\n  x|"y\n#c|d\n')
    for skip, n in ((1, 3), (0, 4)):
        rows, rejects = files.read_delimited(spark, p, "a STRING, b STRING", skip=skip)
        assert rows.count() == n and rejects.count() == 0
    assert {(r.a, r.b) for r in files.read_delimited(spark, p, "a STRING, b STRING", skip=1)[0].collect()} == {
        ('"a', 'b"'), ("  x", '"y'), ("#c", "d")
    }


@pytest.mark.parametrize("n", [0, 1, 2, 3, 100, 101, 102, 103, 1000])
def test_any_number_of_escapes(spark, n):
    """An even number of escapes leaves the delimiter alone, an odd one takes it along."""
    line = "a" + "\\" * n + "|b"
    want = ["a" + "\\" * (n // 2), "b"] if n % 2 == 0 else ["a" + "\\" * (n // 2) + "|b"]
    got = spark.createDataFrame([(line,)], "l string").select(files.split_escaped("l").alias("f")).first().f
    assert got == want


@pytest.mark.parametrize("line,want", [("", [""]), ("|", ["", ""]), ("a\\", ["a\\"]), ("a|b\\", ["a", "b\\"]), ("x" * 50_000 + "|" + "y" * 50_000, ["x" * 50_000, "y" * 50_000]), ("\\\\|", ["\\", ""])])
def test_escaped_edge_cases(spark, line, want):
    assert spark.createDataFrame([(line,)], "l string").select(files.split_escaped("l").alias("f")).first().f == want


def test_header_lines_and_characters_that_are_none(spark, tmp_path):
    """Two files larger than a split, each with its header; a line with U+FFFF is read whole."""
    odd = "a\uffffb|c\uffff\uffff"
    for k in range(2):
        put(tmp_path / f"f{k}.txt", "A|B\n" + "".join(f"{k}x{i}|y\n" for i in range(5000)) + odd + "\n" + "last|line\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        rows, rejects = files.read_delimited(spark, str(tmp_path), "a STRING, b STRING", skip=1)
        assert rows.rdd.getNumPartitions() > 4
        got = [tuple(r) for r in rows.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [(f"{k}x{i}", "y") for k in range(2) for i in range(5000)] + [("a\uffffb", "c\uffff\uffff"), ("last", "line")] * 2
    assert sorted(got) == sorted(want) and rejects.count() == 0


def test_records_never_pass_through_python(spark, tmp_path):
    p = str(tmp_path / "r")
    with open(p, "wb") as f:
        f.write(b"".join(codecs.encode(f"{i:05d}AB ", "cp037") for i in range(20_000)))
    spark.sparkContext._jsc.hadoopConfiguration().set("mapreduce.input.fileinputformat.split.maxsize", "20001")
    try:
        df = files.read_fixed_width(spark, p, [5, 2, 1], ["n", "s", ""])
        assert df.rdd.getNumPartitions() > 4 and df.columns == ["n", "s"]
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.selectExpr("sum(int(n))", "count_if(s = 'AB')").first()[:] == (sum(range(20_000)), 20_000)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("mapreduce.input.fileinputformat.split.maxsize")


def test_code_page_goes_both_ways(spark):
    text = "".join(chr(c) for c in range(32, 127)) + "¢£é"
    df = spark.createDataFrame([(text,)], "t STRING").select(files.encode_ebcdic("t").alias("b"))
    assert bytes(df.first().b) == codecs.encode(text, "cp037")
    assert df.select(files.decode_ebcdic("b")).first()[0] == text
