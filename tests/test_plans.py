"""Shape of the physical plans: no Python rows, no cross products, no single-task window over raw rows."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from leadlake.operators import conform, contracts, evaluate, marts, ranks
from leadlake.plans import fixtures as fx
from leadlake.plans.q_tables import ORDER

# Queries that fit a model (``_hold``) are no plain projections or aggregates.
LIGHT = [n for n in sorted(entry.oracle_sql()) if n.split("_")[0] in (
    "col", "str", "cast", "flt", "null", "lead", "bkt", "feat", "hash", "id", "enc", "num", "ctr", "slv", "jn", "mart",
    "agg", "prof", "bin", "rate", "corr", "ev", "sc", "fair", "pii") and not n.startswith("str_") and not n.endswith("_hold") or n in ("str_clean_all", "str_clean_lead")]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LIGHT)
def test_no_python_and_no_cross_product(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text and "MapInPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filter_and_columns_reach_the_scan(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet").filter("o_totalprice >= 250000").select("o_orderkey")
    text = plan(df)
    assert "GreaterThanOrEqual(o_totalprice,250000.0)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_mart_reads_only_what_it_needs(spark, sf):
    text = plan(entry.queries()["mart_campaign_performance"](spark, sf))
    for unused in ("c_name", "o_totalprice", "c_mktsegment"):
        assert unused not in text


def test_segment_mart_reduces_the_fact_before_the_join(spark, sf):
    leads = contracts.split(fx.leads_dup(spark, sf), contracts.bronze_rules())[0]
    dim, fact = conform.build_dim_customer(leads, ORDER), conform.build_fact_interaction(leads, ORDER)
    tree = marts.segment_conversion(dim, fact)._jdf.queryExecution().optimizedPlan().toString()
    join = tree.index("Join Inner, (customer_id")
    assert re.search(r"Aggregate \[customer_id#\d+\], \[customer_id#\d+, count\(1\)", tree[join:])


def test_order_statistics_group_before_they_sort(spark, sf):
    df = fx.scored(spark, sf)
    text = plan(evaluate.score_steps(df))
    initial = text.split("== Initial Plan ==")[-1]
    # the only window without partitions runs over the range totals
    single = [line for line in initial.splitlines() if "SinglePartition" in line]
    assert len(single) == 1
    after = initial.split(single[0])[1]
    assert "HashAggregate(keys=[_range" in after.splitlines()[1]


def test_grouped_counts_are_made_once(spark, sf):
    df = fx.table(spark, sf, "lineitem")
    steps = ranks.value_ranks(df, ["l_quantity", "l_tax"]).agg(F.max("cum_n"))
    steps.collect()
    assert "ReusedExchange" in plan(steps)


def test_split_moves_no_row(spark, sf):
    assert "Exchange" not in plan(entry.queries()["pii_deidentify"](spark, sf)).replace("BroadcastExchange", "")
