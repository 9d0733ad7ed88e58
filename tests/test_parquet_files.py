"""Rows of one large row group reach many tasks, all of them once."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from assay.sources.parquet_files import read_parquet


def rows_by_task(df):
    counted = df.groupBy(F.spark_partition_id().alias("task")).count().collect()
    return [r["count"] for r in counted]


def test_one_row_group_is_dealt_out(spark, tmp_path):
    path = str(tmp_path / "one.parquet")
    table = pa.table({"key": [7] * 9_000 + [None] * 1_000, "value": list(range(10_000))})
    pq.write_table(table, path, row_group_size=10_000)
    assert rows_by_task(spark.read.parquet(path)) == [10_000]
    dealt = read_parquet(spark, path, rows_per_task=500)
    assert max(rows_by_task(dealt)) <= 1_000
    assert dealt.columns == ["key", "value"]
    assert sorted(r.value for r in dealt.collect()) == list(range(10_000))
    assert dealt.where("key IS NULL").count() == 1_000


@pytest.mark.parametrize("rows", [0, 2_000])
def test_what_a_task_can_hold_is_left_as_it_is(spark, tmp_path, rows):
    path = str(tmp_path / "few.parquet")
    pq.write_table(pa.table({"value": pa.array(range(rows), pa.int64())}), path)
    made = read_parquet(spark, path, rows_per_task=500)
    assert made.count() == rows
    assert "Exchange" not in made._jdf.queryExecution().toString()
