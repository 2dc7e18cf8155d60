"""Inputs beyond what the small tables hold: deep and wide trees, cycles, long numbers, labels and placeholders."""

import pytest
from pyspark.sql import functions as F

from quire.functions import numerals, text
from quire.operators import trees
from quire.sources import catalogue
from quire.streaming import worker


def test_ancestors_of_a_deep_tree_and_of_cycles(spark):
    deep = spark.range(300).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"))
    got = trees.ancestors(deep)
    assert got.count() == 300 * 299 // 2 and got.where("node - ancestor <> depth").count() == 0
    ring = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1), (5, 99), (6, 6)], "id long, parent long")
    assert sorted((r.node, r.ancestor, r.depth) for r in trees.ancestors(ring).collect()) == [(1, 2, 1), (1, 3, 2), (2, 1, 2), (2, 3, 1), (3, 1, 1), (3, 2, 2), (4, 1, 1), (4, 2, 2), (4, 3, 3)]


def test_ancestors_of_two_million_rows(spark):
    wide = spark.range(2_000_000).select("id", F.when(F.col("id") > 0, F.lit(0)).cast("long").alias("parent"))
    assert trees.ancestors(wide).count() == 1_999_999


def test_long_numbers(spark):
    df = spark.createDataFrame([("page 12345678901",), ("9" * 30,), ("- 7 -",)], "v string")
    got = [r.n for r in df.select(numerals.printed_number(F.col("v")).alias("n")).collect()]
    assert [n.value for n in got] == [12345678901, None, 7]
    assert df.select(numerals.page_reference(F.col("v")).alias("n")).count() == 3
    names = spark.createDataFrame([("a" + "1" * 25 + "2",), ("a" + "1" * 25 + "1",), ("a9",), ("a010",)], "v string")
    assert [len(r.v) for r in names.orderBy(text.natural_key(F.col("v"))).collect()] == [2, 4, 27, 27]
    assert names.select(text.natural_key(F.col("v"))).distinct().count() == 4


@pytest.mark.parametrize("value", catalogue.PLACEHOLDERS)
def test_placeholders(spark, value):
    rows = spark.createDataFrame([(f" {value.upper()} ",), ("-",)], "v string").select(text.clean(F.col("v"), catalogue.PLACEHOLDERS).alias("c")).collect()
    assert [r.c for r in rows] == [None, "-"]


def test_one_failing_job_leaves_the_others(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([(i, '{"batch": {"a": 1}}') for i in ("a", "b", "c")], "id string, value string").coalesce(1).write.parquet(str(src))
    jobs = spark.readStream.schema("id string, value string").parquet(str(src))

    def process(df):
        return df.select("id", F.when(F.col("id") == "b", F.raise_error(F.lit("broken"))).otherwise(F.lit(1)).cast("string").alias("x"))

    worker.run_jobs(jobs, process, str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "cp"), None).awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "ok")).collect()) == ["a", "c"]
    assert [r.id for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["b"]
