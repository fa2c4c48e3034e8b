import os

import pytest

from millrace.sinks import files, tables


def files_in(path, ext):
    return [f for f in os.listdir(path) if f.endswith(ext)]


def test_append_orc_and_text(spark, tmp_path):
    p = str(tmp_path / "o")
    files.append(spark.range(2), p)
    files.append(spark.range(3), p)
    assert spark.read.orc(p).count() == 5
    files.write_text(spark.range(2), "id", str(tmp_path / "t"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect()) == ["0", "1"]


def test_published_files_follow_the_size(spark, tmp_path):
    """Forty tasks with little in them give one file, a large result several of about the advised size."""
    files.publish(spark.range(1000).repartition(40), str(tmp_path / "small"))
    assert len(files_in(tmp_path / "small", ".parquet")) == 1
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "200kb")
    try:
        files.publish(spark.range(200_000).selectExpr("id", "uuid() AS u").coalesce(2), str(tmp_path / "large"))
    finally:
        spark.conf.unset(key)
    sizes = [os.path.getsize(tmp_path / "large" / f) for f in files_in(tmp_path / "large", ".parquet")]
    assert len(sizes) > 10 and max(sizes) < 6 * min(sizes)


def test_publish_one_plain_file(spark, tmp_path):
    p = str(tmp_path / "p")
    files.publish(spark.range(100).repartition(4), p, files=1)
    files.publish(spark.range(10).repartition(4), p)
    assert spark.read.parquet(p).count() == 10
    assert len(files_in(p, ".parquet")) == 1 and not files_in(p, ".snappy.parquet")


def test_table_lifecycle(spark):
    tables.drop(spark, "snk_a")
    tables.create_as(spark.range(3), "snk_a")
    with pytest.raises(Exception):
        tables.create_as(spark.range(3), "snk_a")
    tables.drop(spark, "snk_b")
    tables.clone_empty(spark, "snk_a", "snk_b")
    assert spark.table("snk_b").count() == 0
    tables.insert_into(spark.range(5), "snk_b")
    tables.insert_into(spark.range(2), "snk_b")
    assert spark.table("snk_b").count() == 2
    tables.append(spark.range(2), "snk_b", ["id"])
    assert spark.table("snk_b").count() == 4
    tables.analyze(spark, "snk_b", ["id"])
    tables.truncate(spark, "snk_b")
    assert spark.table("snk_b").count() == 0
    tables.overwrite(spark.range(7), "snk_b")
    assert spark.table("snk_b").count() == 7


def test_append_fills_missing_columns(spark):
    tables.drop(spark, "snk_c")
    tables.create_as(spark.sql("SELECT 1 AS a, 'x' AS b"), "snk_c")
    tables.append(spark.sql("SELECT 2 AS a"), "snk_c")
    assert sorted(map(tuple, spark.table("snk_c").collect())) == [(1, "x"), (2, None)]


def test_trap_19_rewrite_a_table_that_is_read(spark):
    tables.drop(spark, "snk_d")
    tables.create_as(spark.range(4), "snk_d")
    tables.rewrite(spark.table("snk_d").filter("id > 1"), "snk_d")
    assert sorted(r.id for r in spark.table("snk_d").collect()) == [2, 3]
    assert not spark.catalog.tableExists("snk_d__old") and not spark.catalog.tableExists("snk_d__next")


def test_swap_that_stopped_half_way(spark):
    """The history is under its old name; appending and swapping find it again."""
    for t in ("snk_h", "snk_h__old", "snk_h__next"):
        tables.drop(spark, t)
    for act in ("append", "rewrite"):
        tables.overwrite(spark.range(3), "snk_h")
        spark.sql("ALTER TABLE snk_h RENAME TO snk_h__old")
        if act == "append":
            tables.append(spark.range(10, 12), "snk_h")
            assert spark.table("snk_h").count() == 5
        else:
            tables.recover(spark, "snk_h")
            tables.rewrite(spark.table("snk_h").union(spark.range(20, 21)), "snk_h")
            assert spark.table("snk_h").count() == 4
        assert not spark.catalog.tableExists("snk_h__old")


def described(spark, table):
    return tables.partition_columns(spark, table), tables.properties(spark, table)


def test_rewrite_keeps_partitions_and_properties_wherever_it_is_killed(spark, monkeypatch):
    class Killed(Exception):
        pass

    def killed_at(step):
        """``spark.sql`` that fails before its ``step``-th statement on a table."""
        seen, run = [0], spark.sql

        def sql(text, *a, **k):
            if text.startswith(("ALTER", "DROP", "MSCK")):
                seen[0] += 1
                if seen[0] == step:
                    raise Killed(text)
            return run(text, *a, **k)

        return sql

    steps = 0
    for step in range(1, 20):
        for t in ("snk_k", "snk_k__old", "snk_k__next"):
            tables.drop(spark, t)
        spark.range(6).selectExpr("id", "id % 2 AS part").write.partitionBy("part").saveAsTable("snk_k")
        spark.sql("ALTER TABLE snk_k SET TBLPROPERTIES ('owner.team' = 'it''s', 'tier' = '2')")
        shape = described(spark, "snk_k")
        assert shape == (["part"], {"owner.team": "it's", "tier": "2"})
        monkeypatch.setattr(spark, "sql", killed_at(step))
        try:
            tables.rewrite(spark.table("snk_k").filter("id > 1"), "snk_k")
        except Killed:
            steps = step
        monkeypatch.undo()
        tables.recover(spark, "snk_k")
        assert spark.table("snk_k").count() in (4, 6) and described(spark, "snk_k") == shape
        tables.rewrite(spark.table("snk_k").filter("id > 1"), "snk_k")
        assert (step, spark.table("snk_k").count()) == (step, 4) and described(spark, "snk_k") == shape
        assert not spark.catalog.tableExists("snk_k__old") and not spark.catalog.tableExists("snk_k__next")
        if steps < step:
            break
    assert steps >= 8


def test_overwrite_partitions(spark):
    tables.drop(spark, "snk_p")
    rows = spark.range(6).selectExpr("id", "id % 3 AS part")
    for _ in range(2):
        tables.overwrite_partitions(rows, "snk_p", ["part"])
        assert spark.table("snk_p").count() == 6
    tables.overwrite_partitions(spark.sql("SELECT 1 AS part, 70 AS id"), "snk_p", ["part"])
    assert sorted(map(tuple, spark.table("snk_p").collect())) == [(0, 0), (2, 2), (3, 0), (5, 2), (70, 1)]
    with pytest.raises(ValueError):
        tables.overwrite_partitions(rows, "snk_p", ["id"])
