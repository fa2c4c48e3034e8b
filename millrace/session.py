"""Session settings shared by the entry point, the benchmark and the tests."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that the operators count on. A join whose output feeds an
# aggregate on the same key is only split by AQE when the split is forced. Arrow
# batches are held by Python and the JVM at once, outside of the heap: 2,000 rows
# of texts or token ids are some megabytes, Spark's 10,000 several times as much.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# Deletes the shuffle files of a job at its end, not when the driver happens to collect
# its garbage; Spark reads it when the job is planned. For jobs whose frame is not run again.
CLEANUP = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a key of the session for as long as the block lasts."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def build_session(app: str = "millrace", master: str | None = None, **settings: str) -> SparkSession:
    """Create a session; ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder.

    The cluster names a shared folder in ``spark.checkpoint.dir``; a temporary
    folder is made only where nothing is set, which is the case in local tests.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="millrace-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it back.

    For what is costly to make and read more than once: it is made once, later
    readers take the columns they need, and a lost executor costs a re-read of
    files. Needs one job; the files stay until the folder is cleared.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
