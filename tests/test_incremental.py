"""Daily runs: equal to a full rebuild, only touched buckets, published whole or not at all."""

import pytest
from pyspark.sql import functions as F

from leadlake.operators import conform, marts
from leadlake.plans import fixtures as fx
from leadlake.plans import incremental
from leadlake.plans.q_tables import ORDER
from leadlake.session import shared_dir
from leadlake.sources.snapshots import Conflict, Draft

TABLES = (incremental.DIM, incremental.FACT, incremental.FEATURES, incremental.CAMPAIGN_MART, incremental.SEGMENT_MART)


def new_lake(spark, buckets=8):
    return incremental.Lake(shared_dir(spark, "lake"), buckets, ORDER)


def content(spark, lake, snapshot=None):
    out = {}
    for name in TABLES:
        df = incremental.table(spark, lake, name, snapshot)
        plain = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes if c != "_processed_at"]
        out[name] = sorted(map(str, df.select(*plain).collect()))
    return out


@pytest.fixture(scope="module")
def leads(spark, sf):
    return fx.leads_dup(spark, sf).filter("src_key % 6 = 0").persist()


@pytest.fixture(scope="module")
def rebuilt(spark, leads):
    lake = new_lake(spark)
    incremental.run_batch(leads, lake, "all")
    return content(spark, lake)


def test_batches_equal_a_full_rebuild(spark, leads, rebuilt):
    lake = new_lake(spark)
    for i in range(2):
        incremental.run_batch(leads.filter(F.pmod(F.xxhash64("src_key", "event_ts"), F.lit(2)) == i), lake, f"day-{i}")
    assert content(spark, lake) == rebuilt and lake.store.versions(spark) == [1, 2]
    assert content(spark, lake, lake.store.at(spark, 1)) != rebuilt  # the version before is still there


def test_a_run_leaves_other_buckets_alone(spark, leads):
    lake = new_lake(spark, 32)
    incremental.run_batch(leads, lake, "day-1")
    before = lake.store.latest(spark)
    few = [r.customer_id for r in leads.filter(
        "age BETWEEN 20 AND 90 AND duration >= 0 AND campaign >= 1").select("customer_id").distinct().orderBy("customer_id").limit(2).collect()]
    batch = leads.filter(F.col("customer_id").isin(few)).withColumn("event_ts", F.col("event_ts") + F.expr("INTERVAL 400 DAYS")).withColumn(
        "balance", F.lit(77.0))
    reads = []

    def watched(snapshot, spark_, table, schema=None, parts=None, plain=incremental.Snapshot.read):
        reads.append((table, None if parts is None else len(list(parts))))
        return plain(snapshot, spark_, table, schema, parts)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(incremental.Snapshot, "read", watched)
        done = incremental.run_batch(batch, lake, "day-2")
    after = lake.store.latest(spark)
    for name in (incremental.DIM, incremental.FACT, incremental.FEATURES):
        moved = {p for p in before.parts[name] if before.parts[name][p] != after.parts[name].get(p)}
        assert 1 <= len(moved) <= done["touched_buckets"] <= 2
        assert all(n is not None and n <= 2 for t, n in reads if t == name)
    assert all(n == 1 for t, n in reads if t == incremental.BRONZE)
    states = incremental.table(spark, lake, incremental.DIM).filter(F.col("customer_id").isin(few)).select("balance").collect()
    assert states and all(r.balance == 77.0 for r in states)


def test_a_batch_that_comes_again_replaces_itself(spark, leads, rebuilt):
    lake = new_lake(spark)
    half = F.col("src_key") % 12 == 0
    wrong = leads.filter(~half).withColumn("job", F.lit("student")).limit(200)
    incremental.run_batch(leads.filter(half), lake, "day-1")
    incremental.run_batch(wrong, lake, "day-2")
    assert content(spark, lake) != rebuilt
    incremental.run_batch(leads.filter(~half), lake, "day-2")
    assert content(spark, lake) == rebuilt
    incremental.run_batch(leads.filter(~half).limit(0), lake, "day-2")
    only = new_lake(spark)
    incremental.run_batch(leads.filter(half), only, "day-1")
    assert content(spark, lake) == content(spark, only)


@pytest.mark.parametrize("broken", [incremental.FACT, incremental.SEGMENT_SUMS, "publish"])
def test_a_killed_run_leaves_the_last_version(spark, leads, broken, monkeypatch):
    lake = new_lake(spark, 4)
    incremental.run_batch(leads.filter("src_key % 12 = 0"), lake, "day-1")
    before = content(spark, lake)
    write, publish = Draft.write_buckets, Draft.publish

    def failing(self, table, df, touched):
        write(self, table, df, touched)
        if table == broken:
            raise KeyboardInterrupt("killed")

    def never(self):
        raise KeyboardInterrupt("killed")

    monkeypatch.setattr(Draft, "write_buckets", failing)
    if broken == "publish":
        monkeypatch.setattr(Draft, "publish", never)
    with pytest.raises(KeyboardInterrupt):
        incremental.run_batch(leads.filter("src_key % 12 <> 0"), lake, "day-2")
    assert content(spark, lake) == before
    monkeypatch.setattr(Draft, "write_buckets", write)
    monkeypatch.setattr(Draft, "publish", publish)
    assert incremental.run_batch(leads.filter("src_key % 12 <> 0"), lake, "day-2")["version"] == 2


def test_state_and_news_meet_in_one_aggregate(spark, leads):
    """Each row is shuffled once: news are not reduced on their own before they meet the state, and ids come after the shuffle."""
    late = F.col("src_key") % 12 == 0
    for build in (conform.build_dim_customer, conform.build_fact_interaction):
        old, whole = build(leads.filter(~late), ORDER, ORDER), build(leads, ORDER, ORDER)
        path = shared_dir(spark, "state")
        old.write.parquet(path)
        both = build(leads.filter(late), ORDER, ORDER, spark.read.parquet(path))
        assert sorted(map(str, both.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
        plan = both._jdf.queryExecution().analyzed().toString()
        assert plan.count("Aggregate [") == 1 and "sha2(" not in plan.split("Aggregate [")[1].split("\n", 1)[1]


def test_keys_are_audited_by_hash(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert not incremental._repeated(rows, "k") and not incremental._repeated(rows.limit(0), "k")
    assert incremental._repeated(rows.union(rows.filter("k = 'b'")), "k")
    assert incremental._repeated(rows.union(rows.filter("k IS NULL")), "k")


def test_audit_stops_a_contradiction(spark, leads, monkeypatch):
    lake = new_lake(spark, 4)
    real = marts.campaign_sums
    monkeypatch.setattr(marts, "campaign_sums", lambda fact, *by: real(fact.filter("month <> 'may'"), *by))
    with pytest.raises(incremental.AuditFailed, match="campaign sums"):
        incremental.run_batch(leads, lake, "day-1")
    assert lake.store.versions(spark) == []


def test_of_two_runs_from_one_version_one_is_published(spark, leads):
    lake = new_lake(spark, 4)
    first, second = lake.store.begin(spark), lake.store.begin(spark)
    rows = spark.range(3).toDF("n")
    assert first.write_part("t", "all", rows) == 3 and second.write_part("t", "all", rows.limit(1)) == 1
    first.publish()
    with pytest.raises(Conflict):
        second.publish()
    assert lake.store.latest(spark).read(spark, "t").count() == 3


def test_bad_rows_and_empty_batches(spark, leads):
    lake = new_lake(spark, 4)
    done = incremental.run_batch(leads.limit(0), lake, "empty")
    assert done["version"] == 1 and done["touched_buckets"] == 0
    done = incremental.run_batch(leads.limit(5).withColumn("age", F.lit(3)), lake, "bad")
    assert done["bronze_records"] == 5 and done["dim_records"] == 0
