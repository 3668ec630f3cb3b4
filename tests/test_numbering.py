"""Distributed numbering equals row_number."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from matchmart.operators.latest import keep_first
from matchmart.operators.numbering import dense_ids, number_within


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_dense_ids(spark, space, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        frame = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), "id")
        rows = dense_ids(frame, ["k"], "n", space, start=50).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r.n for r in sorted(rows, key=lambda r: r.k)] == list(range(51, 1051))


def test_dense_ids_of_nothing(spark, space):
    none = dense_ids(spark.range(0).withColumn("k", F.lit("x")), ["k"], "n", space)
    assert none.count() == 0 and dict(none.dtypes)["n"] == "bigint"


def test_number_within_a_huge_group(spark):
    group = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97)
    frame = spark.range(5000).select(group.alias("g"), (F.col("id") * 7919 % 50).alias("b"), F.col("id").alias("o"))
    window = Window.partitionBy("g").orderBy("b", "o")
    expected = frame.withColumn("n", F.row_number().over(window))
    actual = number_within(frame, ["g"], ["b"], ["o"], "n")
    assert sorted(map(tuple, actual.select("g", "b", "o", "n").collect())) == sorted(map(tuple, expected.collect()))


def test_keep_first_limits_before_the_exchange(spark):
    plan = keep_first(spark.range(100).withColumn("k", F.col("id") % 5), ["k"], [F.col("id").desc()])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2
    assert sorted(r.id for r in plan.collect()) == [95, 96, 97, 98, 99]
