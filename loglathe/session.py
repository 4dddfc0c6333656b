"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

REQUIRED_SETTINGS = {
    # Every stored timestamp is UTC text.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key takes its last value instead of spoiling the line.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Re-plan joins on measured sizes and split skewed partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles methods above 8000 bytes of code. A long projection is
    # faster outside whole-stage code, where Spark splits it into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Long texts and blobs reach Python a few megabytes at a time.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def configure_session(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may go without that setting: it gets a new folder of
    its own, since driver and executors are then one process.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current is None:
        if not _is_local(spark):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="loglathe-", dir="/tmp"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df, label: str):
    """Write an intermediate to the shared folder and read it back.

    Whatever runs later sees the same rows, in the same partitions' order, and evaluates
    nothing of ``df`` again.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *tables) -> None:
    """Delete scratch tables made by ``materialize`` that nothing reads any more."""
    for table in tables:
        for name in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df):
    """Materialise a small intermediate on reliable storage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
