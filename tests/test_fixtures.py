"""The log lines derived from the events table."""

from __future__ import annotations

import datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from loglathe import fixtures


def _events(folder, rows, row_group_size):
    stamp = datetime.datetime(2024, 1, 1)
    pq.write_table(pa.table({
        "event_id": pa.array(range(rows), pa.int64()), "user_id": pa.array(range(rows), pa.int64()),
        "event_type": ["click"] * rows, "ts": pa.array([stamp] * rows, pa.timestamp("us")),
        "value": [0.5] * rows}), f"{folder}/events.parquet", row_group_size=row_group_size)


def test_few_row_groups_of_many_splits_keep_all_cores_busy(spark, folder):
    _events(folder, 8000, 8000)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, "4096")
    try:
        assert spark.read.parquet(f"{folder}/events.parquet").rdd.getNumPartitions() >= 8
        lines = fixtures.log_lines(spark, folder)
        per_task = lines.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(r["count"] for r in per_task) == 8000
    assert max(r["count"] for r in per_task) < 8000 / 4


def test_balanced_splits_are_not_shuffled(spark, folder):
    table = spark.range(8000).repartition(8)
    table.write.parquet(f"{folder}/events.parquet")
    read = spark.read.parquet(f"{folder}/events.parquet")
    kept = fixtures.spread(read, "id")
    assert kept is read or read.rdd.getNumPartitions() < 8


def test_an_empty_table_has_no_lines(spark, folder):
    _events(folder, 0, 1)
    assert fixtures.log_lines(spark, folder).count() == 0
