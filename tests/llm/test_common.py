"""Helpers of the training-data operators."""

import re
import time

from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.common import CLEANUP, discard, materialise, shuffles_cleared, spread


def tasks_with_rows(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_one_row_group_is_spread_and_many_files_are_left(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(200).select("id", F.repeat(F.lit("x"), 50).alias("text"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    rows.repartition(cores).write.parquet(str(tmp_path / "many"))
    one, many = spark.read.parquet(str(tmp_path / "one")), spark.read.parquet(str(tmp_path / "many"))
    assert tasks_with_rows(one) == 1 < cores
    got = spread(one)
    assert tasks_with_rows(got) == cores
    assert sorted(got.collect()) == sorted(rows.collect())
    assert spread(many) is many
    picked = one.where("id % 2 = 0").select("id")
    assert sorted(r.id for r in spread(picked, one).collect()) == list(range(0, 200, 2))
    assert spread(one.where("false")).count() == 0
    assert spread(spark.createDataFrame([], "id long")).count() == 0


def test_shuffles_are_cleared(spark):
    """Files of a shuffle go with its query inside, and the session is as before afterwards."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return set(re.findall(r"shuffle_\d+_", files.getAllFiles().mkString(" ")))

    def query():
        assert len(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().collect()) == 7

    before, setting = shuffled(), spark.conf.get(CLEANUP, None)
    with shuffles_cleared(spark):
        query()
        end = time.monotonic() + 20
        while shuffled() - before and time.monotonic() < end:
            time.sleep(0.1)
        assert not shuffled() - before
    assert spark.conf.get(CLEANUP, None) == setting


def test_discard_takes_only_its_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    one, two = materialise(spark.range(3), "one"), materialise(spark.range(4), "two")
    discard(one)
    assert [p.name.partition("-")[0] for p in tmp_path.iterdir()] == ["two"] and two.count() == 4
