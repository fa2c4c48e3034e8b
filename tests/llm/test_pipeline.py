"""The pipeline's stages and the package's SQL forms."""

import os
from collections import defaultdict

import pytest
from compare import connect, difference

import __spark_entry__ as entry_points
import corpus_pipeline
from millrace.llm.queries import QUERIES
from test_native import expected_counts, expected_groups, words_of  # noqa: I001
from test_pairs import expected_components
from millrace.llm.token_groups import Similarity

FOLDER = os.environ.get("PARITY_DIR", "/root/testdata/sf0.001")


def test_stages_on_a_small_corpus(spark, corpus, docs, tmp_path):
    """Each stage against plain Python, on what its predecessor kept."""
    rows = [(i, t, s) for i, t, _, s, _ in corpus]
    frame, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        kept[name] = frame
        if name != "pack_sequences":
            assert frame.columns == docs.columns
    good = [r for r in rows if (c := expected_counts(r[1]))[0] >= 20 and 100 * c[4] <= 30 * c[0]]
    assert sorted((r.doc_id, r.text) for r in kept["quality_rules"].collect() if r.doc_id is not None) == sorted(r[:2] for r in good if r[0] is not None)
    groups = expected_groups(good)
    single = [(max((i for i in ids if i is not None), default=None), t) for t, ids in groups.items()]
    got = [(r.doc_id, r.text) for r in kept["exact_dedup"].collect()]
    assert len(got) == len(single) and {i for i, _ in got} == {i for i, _ in single}
    wanted = {i for i, _, c in expected_components(got, Similarity()) if i is None or i == c}
    assert {r.doc_id for r in kept["near_dedup"].collect()} == wanted
    size = {r.doc_id: len(words_of(r.text)) for r in kept["near_dedup"].collect()}
    assert sum(len(words_of(r.text)) for r in kept["mix_sources"].collect()) == pytest.approx(sum(size.values()), rel=0.25)
    copies = defaultdict(int)
    for r in kept["mix_sources"].collect():
        copies[r.doc_id] += 1
    pieces = kept["pack_sequences"].filter("piece = 0").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in pieces} == dict(copies) and max(copies.values()) <= 3


def test_no_stage_filters_by_recomputed_counts(spark, docs, tmp_path):
    """A filter that Spark pushed below the counts would split every text once for each window of it."""
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, str(tmp_path))
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in plan.splitlines() if line.strip(" :+-*|").startswith("Filter")]
        assert not [f for f in filters if "split(" in f or "xxhash64(" in f], name


def test_run_leaves_no_tables_of_its_stages(spark, docs, tmp_path):
    from millrace.llm.shared import scratch, written
    from millrace.session import ensure_checkpoint_dir
    from millrace.sinks.folders import Folder

    folder = Folder(spark, ensure_checkpoint_dir(spark))
    before = set(folder.names())
    with pytest.raises(ZeroDivisionError), scratch(spark):
        written(spark.range(3))
        1 / 0
    assert set(folder.names()) == before
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    left = set(folder.names()) - before
    assert len(left) < 5 and len([n for n in left if n.startswith("pipeline-")]) == 1


def test_empty_documents(spark, no_docs, tmp_path):
    frame = no_docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frame, str(tmp_path)).write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        assert frame.count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), QUERIES[name].sql) is None


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES} - {"pipeline"} and "pipeline" in QUERIES
    assert set(QUERIES) <= set(entry_points.queries())
