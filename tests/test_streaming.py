import json

import pytest

from test_reservations import CASES, dims  # noqa: F401

from millrace.plans.reservations import parse_reservations
from millrace.schemas import RESERVATION
from millrace.sinks import folders as folders_mod
from millrace.sources.files import parse_json, quarantine
from millrace.sources.streams import read_stream
from millrace.streaming.ingest import ingest_batch, run_stream, write_batch


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def lines():
    return [json.dumps(m) for m in CASES] + ['{"broken']


def run(spark, folders, dims):  # noqa: F811
    source = read_stream(spark, "text", str(folders / "in"), maxFilesPerTrigger="2")
    handle = ingest_batch(RESERVATION, lambda m: parse_reservations(m, dims), str(folders / "good"), str(folders / "bad"))
    run_stream(source, handle, str(folders / "offsets"), every=None).awaitTermination()


def rows(df):
    return sorted(map(str, df.select("confo_num_orig", "baseAmount", "baseAmountLocal", "date_arrival_key", "errorDescription").collect()))


def test_stream_equals_batch_and_restart_adds_nothing(spark, folders, dims):  # noqa: F811
    for i, line in enumerate(lines()):
        (folders / "in" / f"{i}.json").write_text(line + "\n")
    run(spark, folders, dims)
    good = spark.read.orc(str(folders / "good"))
    text = spark.createDataFrame([(line,) for line in lines()], "value STRING")
    batch = parse_reservations(quarantine(parse_json(text, "value", RESERVATION))[0].select("message.*"), dims)
    assert rows(good) == rows(batch)
    assert spark.read.text(str(folders / "bad")).count() == 1
    assert good.select("batch_id").distinct().count() > 1
    run(spark, folders, dims)
    assert rows(spark.read.orc(str(folders / "good"))) == rows(batch)


def test_trap_24_single_message_is_processed(spark, folders, dims):  # noqa: F811
    (folders / "in" / "one.json").write_text(lines()[0] + "\n")
    run(spark, folders, dims)
    assert spark.read.orc(str(folders / "good")).count() == 1


def test_replayed_batch_overwrites_its_folder(spark, tmp_path):
    p = str(tmp_path / "out")
    write_batch(spark.range(3), 7, p)
    write_batch(spark.range(3), 7, p)
    write_batch(spark.range(2), 8, p)
    assert spark.read.orc(p).count() == 5


def test_timed_trigger(spark, folders):
    (folders / "in" / "a.txt").write_text("x\n")
    seen = []
    query = run_stream(
        read_stream(spark, "text", str(folders / "in")), lambda df, i: seen.append(df.count()), str(folders / "o"), "2 seconds", "timed"
    )
    query.processAllAvailable()
    query.stop()
    assert seen == [1]


def test_batch_ingest_equals_plan_and_can_be_repeated(spark, folders, dims):  # noqa: F811
    from millrace.plans.loads import IngestResult, ingest_messages

    (folders / "in" / "all.json").write_text("\n".join(lines()) + "\n")
    args = (spark, str(folders / "in"), RESERVATION, lambda m: parse_reservations(m, dims), str(folders / "good"),
            str(folders / "bad"), str(folders / "staged"), "2024-02-01")
    for _ in range(2):
        assert ingest_messages(*args) == IngestResult(len(CASES) + 1, len(CASES), 1)
    text = spark.createDataFrame([(line,) for line in lines()], "value STRING")
    batch = parse_reservations(quarantine(parse_json(text, "value", RESERVATION))[0].select("message.*"), dims)
    assert rows(spark.read.orc(str(folders / "good"))) == rows(batch)
    assert [r.value for r in spark.read.text(str(folders / "bad")).collect()] == ['{"broken']


class Killed(Exception):
    pass


def test_batch_killed_between_its_writes_leaves_one_copy(spark, tmp_path, monkeypatch):
    from millrace.streaming import ingest

    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    handle = ingest_batch("k INT", lambda g: g, good, bad)
    text = spark.createDataFrame([('{"k": 1}',), ('{"k": 2}',), ("{broken",)], "value STRING")
    write = ingest.write_batch

    def killed(df, batch_id, path, fmt="orc"):
        if path == good:
            raise Killed
        write(df, batch_id, path, fmt)

    monkeypatch.setattr(ingest, "write_batch", killed)
    with pytest.raises(Killed):
        handle(text, 3)
    monkeypatch.undo()
    assert folders_mod.Folder(spark, good).names("_committed") == []
    for _ in range(2):
        handle(text, 3)
    assert sorted(r.k for r in spark.read.orc(good).collect()) == [1, 2] and spark.read.text(bad).count() == 1
    assert folders_mod.Folder(spark, good).names("_committed") == ["batch_id=3"] and not folders_mod.Folder(spark, good).names("_staged")


def many_batches(spark, path, n):
    import pyarrow as pa
    import pyarrow.orc as orc

    for i in range(n):
        (path / f"batch_id={i}").mkdir(parents=True)
        orc.write_table(pa.table({"k": [i, i]}), str(path / f"batch_id={i}" / "part-0.orc"))


def test_thousand_batches_become_few_files(spark, tmp_path):
    path = tmp_path / "out"
    many_batches(spark, path, 1000)
    assert folders_mod.compact(spark, str(path)) == 999
    assert folders_mod.batches(folders_mod.Folder(spark, str(path))) == [998, 999]
    files = [f for f in (path / "batch_id=998").iterdir() if f.name.startswith("part-")]
    assert len(files) < 5
    got = spark.read.orc(str(path))
    assert sorted(r.k for r in got.collect()) == sorted(list(range(1000)) * 2)
    assert folders_mod.compact(spark, str(path)) == 0


@pytest.mark.parametrize("step", range(1, 8))
def test_compaction_killed_anywhere_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, step):
    path = tmp_path / "out"
    many_batches(spark, path, 5)
    seen = [0]

    def counted(name):
        act = getattr(folders_mod.Folder, name)

        def run(self, *args):
            seen[0] += 1
            if seen[0] == step:
                raise Killed
            return act(self, *args)

        return run

    for name in ("delete", "rename"):
        monkeypatch.setattr(folders_mod.Folder, name, counted(name))
    try:
        folders_mod.compact(spark, str(path))
    except Killed:
        pass
    monkeypatch.undo()
    folders_mod.recover(spark, str(path))
    assert sorted(r.k for r in spark.read.orc(str(path)).collect()) == sorted(list(range(5)) * 2)
    folders_mod.compact(spark, str(path))
    assert folders_mod.batches(folders_mod.Folder(spark, str(path))) == [3, 4]
    assert sorted(r.k for r in spark.read.orc(str(path)).collect()) == sorted(list(range(5)) * 2)


def test_stream_compacts_as_it_goes(spark, tmp_path):
    handle = ingest_batch("k INT", lambda g: g, str(tmp_path / "good"), str(tmp_path / "bad"), compact_every=3)
    for i in range(7):
        handle(spark.createDataFrame([(f'{{"k": {i}}}',), ("{",)], "value STRING"), i)
    assert folders_mod.batches(folders_mod.Folder(spark, str(tmp_path / "good"))) == [5, 6]
    assert sorted(r.k for r in spark.read.orc(str(tmp_path / "good")).collect()) == list(range(7))
    assert spark.read.text(str(tmp_path / "bad")).count() == 7
