"""Batches of streams are written and read by many tasks."""

import pytest
from pyspark.sql import DataFrame

from utterlake.plans import catalogue
from utterlake.streaming import maintain

SF = "/root/testdata/sf0.001"


def test_a_part_is_split_over_tasks(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 8).selectExpr("concat('f', id) AS path", "1L AS at", "false AS removed", "'c' AS corpus", "array(named_struct('order', 1, 'speaker', 's', 'tokens', array(sha2(string(id), 512)))) AS utterances")
    held = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in held.items():
        spark.conf.set(key, value)
    try:
        maintain.writer(str(tmp_path), parts=1)(rows, 0)
    finally:
        for key in held:
            spark.conf.unset(key)
    assert len(list((tmp_path / "file/batch=000000000/part=0").glob("*.parquet"))) > 1
    assert maintain.table(spark, str(tmp_path), "token").count() == 4000


@pytest.mark.parametrize("name", ["stream_sightings", "maintained_summaries"])
def test_no_batch_goes_through_one_task(spark, monkeypatch, name):
    def refused(self, n):
        raise AssertionError("a batch in one task")

    monkeypatch.setattr(DataFrame, "coalesce", refused)
    monkeypatch.setattr(type(spark.range(1)), "coalesce", refused)
    assert catalogue.queries()[name](spark, SF).count() > 0
