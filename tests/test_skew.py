"""Hot keys: found by the sketch, cut into pieces, nothing lost."""

import collections

import pytest
from pyspark.sql import functions as F

from leadlake.operators import conform, skew


@pytest.fixture
def plain_joins(spark):
    """Neither broadcasts nor merged partitions."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def facts(spark, n=30_000):
    """A third of all interactions belongs to one customer, as many rows have none."""
    customer = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("c"), (F.col("id") % 4000).cast("string")))
    return spark.range(n).select(
        customer.alias("customer_id"), F.lit("cellular").alias("contact"), (F.col("id") % 28).cast("int").alias("day"), F.lit("may").alias("month"),
        F.col("id").cast("double").alias("duration"), F.lit(1).alias("campaign"), F.col("id").alias("n"))


def sizes_of(df):
    """Rows of each task behind the join; a column of the other side keeps the join in the plan."""
    return [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max("age")).collect()]


def customers(spark):
    ids = spark.range(4000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("customer_id")).union(spark.sql("SELECT 'hot'"))
    return ids.groupBy("customer_id").agg(F.max(F.length("customer_id")).alias("age"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_no_task_gets_the_hot_customer_whole(spark, plain_joins, how):
    fact, dim = facts(spark), customers(spark)
    joined = skew.join(fact, dim, "customer_id", ["day", "duration"], how, parts=16)
    sizes = sizes_of(joined)
    rows = sum(sizes)
    assert rows == (20_000 if how == "inner" else 30_000)
    assert max(sizes) <= 3 * rows / 16
    plain = fact.join(dim, "customer_id", how)
    assert max(sizes_of(plain)) >= 10_000
    assert joined.select(sorted(joined.columns)).exceptAll(plain.select(sorted(plain.columns))).isEmpty() and plain.count() == rows


def test_dimension_join_cuts_hot_customers(spark, plain_joins):
    fact, dim = facts(spark), customers(spark)
    joined = conform.join_dim_fact(dim, fact, fact)
    assert max(sizes_of(joined)) <= 3 * 20_000 / 16
    assert joined.count() == 20_000


def test_sketch_names_every_heavy_key(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 4 == 0, -1).when(F.col("id") % 10 == 1, -2).otherwise(F.col("id")).alias("k"))
    pieces = dict(skew.heavy_keys(df, "k", 16))
    counts = collections.Counter(r.k for r in df.collect())
    assert set(pieces) == {k for k, n in counts.items() if n > 20_000 / 16} and pieces[-1] >= 4
    assert skew.heavy_keys(df.filter("k > 0"), "k", 16) == [] and skew.heavy_keys(df.limit(0), "k", 16) == []


def test_join_without_hot_keys_or_rows(spark):
    fact, dim = facts(spark).filter("customer_id <> 'hot' OR customer_id IS NULL"), customers(spark)
    assert skew.join(fact, dim, "customer_id", ["n"]).count() == 10_000
    assert skew.join(fact, dim, "customer_id", ["n"], "left").count() == 20_000
    assert skew.join(fact.limit(0), dim, "customer_id", ["n"], "left").count() == 0
    with pytest.raises(ValueError):
        skew.join(fact, dim, "customer_id", ["n"], "right")
