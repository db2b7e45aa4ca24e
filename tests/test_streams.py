"""Streaming jobs against their batch twins, over several batches, with replays and late rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leadlake.operators import drift
from leadlake.plans import fixtures as fx
from leadlake.plans import lakehouse
from leadlake.session import shared_dir
from leadlake.sources.snapshots import Draft, Store
from leadlake.streaming import jobs


@pytest.fixture
def files(spark, sf):
    """Events split over six files, read one file per batch in time order."""
    path = shared_dir(spark, "events")
    events = fx.table(spark, sf, "events").repartitionByRange(6, "ts").sortWithinPartitions("ts")
    events.write.parquet(path)
    return path


def stream(spark, path, schema, per_batch=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def feedback(spark, files):
    return fx.feedback_from(stream(spark, files, spark.read.parquet(files).schema))


def rows(df):
    return sorted(map(str, df.collect()))


def test_log_equals_batch_and_restart_adds_nothing(spark, files):
    path, checkpoint = shared_dir(spark, "log"), shared_dir(spark, "checkpoint")
    for _ in range(2):
        jobs.drain(jobs.feedback_log(feedback(spark, files), path, checkpoint))
    want = jobs.feedback_records(fx.feedback_from(spark.read.parquet(files)))
    assert rows(spark.read.parquet(path)) == rows(want)


def test_window_counts_equal_batch(spark, files):
    path = shared_dir(spark, "counts")
    jobs.drain(jobs.keep_counts(jobs.outcome_counts(feedback(spark, files)), path, shared_dir(spark, "checkpoint")))
    want = jobs.outcome_counts(fx.feedback_from(spark.read.parquet(files)))
    assert rows(jobs.latest_counts(spark, path, "window_start timestamp, outcome string")) == rows(want)


def test_count_log_is_merged_and_replayed_once(spark, monkeypatch):
    """Twenty batches leave few parts and folders; a batch that fails before it is published is added once."""
    monkeypatch.setattr(jobs, "MERGE", 3)
    source, path, checkpoint = shared_dir(spark, "in"), shared_dir(spark, "counts"), shared_dir(spark, "checkpoint")
    schema = "customer_id string, feedback_id long"
    for i in range(20):
        spark.createDataFrame([(f"c{i % 4}", i)], schema).coalesce(1).write.mode("append").parquet(source)
    events = stream(spark, source, spark.read.parquet(source).schema)
    publish, seen = Draft.publish, []

    def once_failing(draft):
        seen.append(draft.base.version)
        if len(seen) == 8:
            raise RuntimeError("lost")
        return publish(draft)

    monkeypatch.setattr(Draft, "publish", once_failing)
    with pytest.raises(Exception, match="lost"):
        jobs.drain(jobs.keep_totals(events, path, checkpoint))
    jobs.drain(jobs.keep_totals(events, path, checkpoint))
    assert {r.customer_id: r.n for r in jobs.latest_totals(spark, path).collect()} == {f"c{i}": 5 for i in range(4)}
    store = Store(path)
    last = store.latest(spark)
    assert last.version == 20 and len(last.parts["log"]) <= 2 * 3 and len(store.versions(spark)) <= 4
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data/log")
    folders = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    holding = [f for f in folders if len(list(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(f.getPath())))]
    assert len(holding) <= 2 * 3 + 2 * 4 + 1


def test_a_new_checkpoint_is_refused_on_an_old_folder(spark, files):
    path = shared_dir(spark, "totals")
    jobs.drain(jobs.keep_totals(feedback(spark, files), path, shared_dir(spark, "checkpoint")))
    with pytest.raises(ValueError, match="another stream"):
        jobs.keep_totals(feedback(spark, files), path, shared_dir(spark, "checkpoint"))


def test_totals_are_exact_over_batches(spark, files):
    path = shared_dir(spark, "totals")
    jobs.drain(jobs.keep_totals(feedback(spark, files), path, shared_dir(spark, "checkpoint")))
    assert rows(jobs.latest_totals(spark, path)) == rows(jobs.customer_totals(fx.feedback_from(spark.read.parquet(files))))


def test_repeats_across_batches_are_dropped(spark, files):
    twice = feedback(spark, files).unionByName(feedback(spark, files))
    path = shared_dir(spark, "once")
    jobs.drain(jobs.to_parquet(jobs.drop_repeated(twice), path, shared_dir(spark, "checkpoint")))
    got = spark.read.parquet(path)
    assert got.count() == got.select("feedback_id").distinct().count() == spark.read.parquet(files).count()


def test_late_rows_are_counted_and_logged(spark):
    path = shared_dir(spark, "late")
    day = dt.datetime(2024, 1, 1, 12)
    schema = "feedback_id string, customer_id string, agent_id string, call_duration int, outcome string, recorded_at timestamp"
    counts, log = shared_dir(spark, "counts"), shared_dir(spark, "log")
    check_counts, check_log = shared_dir(spark, "c1"), shared_dir(spark, "c2")
    for name, days in (("f1", 0), ("f2", 3), ("f3", 0), ("f4", 9)):  # f3 comes three days late
        delivery = [(name, "c", "a", 5, "agreed", day + dt.timedelta(days=days))]
        spark.createDataFrame(delivery, schema).coalesce(1).write.mode("append").parquet(path)
        source = spark.readStream.schema(schema).parquet(path)
        jobs.drain(jobs.keep_counts(jobs.outcome_counts(source), counts, check_counts))
        jobs.drain(jobs.feedback_log(source, log, check_log))
    found = jobs.latest_counts(spark, counts, "window_start timestamp, outcome string").collect()
    assert sorted(r.n for r in found) == [1, 1, 2]
    assert spark.read.parquet(log).count() == 4


def test_second_stream_adds_to_bronze(spark, sf):
    path, layers = shared_dir(spark, "raw"), lakehouse.Layers(shared_dir(spark, "lake"))
    raw = fx.leads_raw(spark, sf).drop("event_ts")
    raw.coalesce(1).write.parquet(path)
    for _ in range(2):
        jobs.drain(jobs.ingest(stream(spark, path, raw.schema), layers, shared_dir(spark, "checkpoint")))
    assert spark.read.parquet(layers.bronze).count() == 2 * raw.count()


def test_ingest_over_batches_and_restart(spark, sf):
    path, layers = shared_dir(spark, "raw"), lakehouse.Layers(shared_dir(spark, "lake"))
    raw = fx.leads_raw(spark, sf).drop("event_ts")
    raw.repartition(3).write.parquet(path)
    checkpoint = shared_dir(spark, "checkpoint")
    for _ in range(2):
        jobs.drain(jobs.ingest(stream(spark, path, raw.schema), layers, checkpoint))
    bronze = spark.read.parquet(layers.bronze)
    assert bronze.count() == raw.count() and bronze.select("_batch_id").distinct().count() == 3


def test_drift_per_batch_raises_alerts(spark, sf):
    leads = fx.leads_raw(spark, sf).select("src_key", "age", "balance", "day", "campaign")
    edges = drift.inner_edges(leads, drift.DRIFT_FEATURES)
    expected, path, source = shared_dir(spark, "expected"), shared_dir(spark, "drift"), shared_dir(spark, "in")
    drift.bin_counts(leads, edges, "e").write.parquet(expected)
    leads.coalesce(1).write.parquet(source)
    leads.withColumn("age", F.col("age") + 60).coalesce(1).write.mode("append").parquet(source)
    jobs.drain(jobs.watch_drift(stream(spark, source, leads.schema), edges, expected, path, shared_dir(spark, "checkpoint")))
    row = jobs.drift_alerts(spark.read.parquet(path)).first()
    assert (row.batches, row.alerts) == (2, 1)


def test_latency_buckets_are_cumulative(spark):
    df = spark.createDataFrame([(0.005,), (0.05,), (0.3,), (9.0,)], "latency double")
    r = jobs.latency_histogram(df).first()
    assert (r.le_0_01, r.le_0_05, r.le_0_1, r.le_0_25, r.le_0_5, r.le_2_5, r.le_inf) == (1, 2, 2, 2, 3, 3, 4)
