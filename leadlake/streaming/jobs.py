"""Structured Streaming jobs. No event is dropped for being late; a state is bounded by its keys; every sink is
idempotent: a batch that is run again replaces what it wrote the first time."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leadlake.config import DEFAULT, DRIFT_FEATURES, LATENCY_BUCKETS, OUTCOMES, Settings
from leadlake.operators import contracts, drift
from leadlake.operators.score import priority_tier
from leadlake.operators.train import TrainedModel
from leadlake.plans.lakehouse import Layers, ingest_frame, score_leads
from leadlake.sources.sinks import append_batch, overwrite_table
from leadlake.sources.snapshots import Store


def drain(query: StreamingQuery) -> None:
    """Wait until everything available has been processed."""
    query.awaitTermination()


def _start(df: DataFrame, checkpoint: str, mode: str = "append", available_now: bool = True):
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if available_now else writer


def _each_batch(df: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None], mode: str = "append",
                available_now: bool = True) -> StreamingQuery:
    return _start(df, checkpoint, mode, available_now).foreachBatch(work).start()


def to_parquet(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    return _start(df, checkpoint, "append", available_now).format("parquet").option("path", path).start()


def stream_name(checkpoint: str) -> str:
    """A short name of the stream that a checkpoint folder belongs to."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]


# --- Ingest -----------------------------------------------------------------------

def ingest(raw: DataFrame, layers: Layers, checkpoint: str, settings: Settings = DEFAULT,
           available_now: bool = True) -> StreamingQuery:
    """Raw files to Bronze and quarantine. The batch id names the stream (by its checkpoint) and the batch, so a replay
    overwrites itself and another stream, or a new checkpoint, does not."""
    stream = stream_name(checkpoint)

    def work(batch: DataFrame, batch_id: int) -> None:
        ingest_frame(batch, layers, f"stream-{stream}-{batch_id:08d}", settings, "stream")

    return _each_batch(raw, checkpoint, work, available_now=available_now)


# --- Call outcomes ----------------------------------------------------------------

def feedback_records(feedback: DataFrame) -> DataFrame:
    """Valid outcomes as log records with their yes/no label; works on a batch and on a stream."""
    valid, _ = contracts.split(feedback, contracts.feedback_rules())
    notes = F.coalesce(F.col("notes"), F.lit("")) if "notes" in feedback.columns else F.lit("")
    return valid.select(
        "feedback_id", "customer_id", "agent_id", "call_duration", "outcome",
        F.when(F.col("outcome") == "agreed", "yes").otherwise("no").alias("y_label"), notes.alias("notes"), "recorded_at",
    )


def feedback_log(feedback: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append-only log, written before any watermark: a late outcome is still an outcome."""
    return to_parquet(feedback_records(feedback), path, checkpoint, available_now)


def drop_repeated(feedback: DataFrame) -> DataFrame:
    """One row per feedback id, however late it or its repeats come: the state keeps every id (and nothing else), so a
    large log wants the RocksDB state store."""
    return feedback.dropDuplicates(["feedback_id"])


def counted_outcome(outcome: Column) -> Column:
    """Outcomes outside the contract are counted as declined."""
    name = F.lower(outcome)
    return F.when(name.isin(*OUTCOMES), name).otherwise(F.lit("declined"))


def outcome_counts(feedback: DataFrame, width: str = "1 day") -> DataFrame:
    """(day, outcome, n) per tumbling window. No watermark: a late event is added to its window; the state holds one row
    per window and outcome."""
    counts = feedback.groupBy(F.window("recorded_at", width), counted_outcome(F.col("outcome")).alias("outcome"))
    return counts.agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), "outcome", "n")


def customer_totals(feedback: DataFrame) -> DataFrame:
    return feedback.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))


#: Batches, and then merged parts of one level, that are merged into a part of the next level.
MERGE = 8
_LOG, _STREAM = "log", "stream"


def _newest(rows: DataFrame) -> DataFrame:
    """The newest count of each key."""
    names = [c for c in rows.columns if c not in ("n", "batch")]
    return rows.groupBy(*names).agg(F.max_by("n", "batch").alias("n"), F.max("batch").alias("batch"))


def keep_counts(counts: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Running counts as a log of levels: each batch adds the counts it changed, every ``MERGE`` batches are merged to the newest
    count of each key, every ``MERGE`` of those again, so that a reader never meets more than a few parts a level.

    Batch, merges and progress are published together: a batch that runs again after a failure is added once, and a reader
    sees all of it or nothing. A folder belongs to one stream: another checkpoint, whose counts would begin at zero, is refused.
    """
    store, stream = Store(path, keep=4), stream_name(checkpoint)
    owners = set(store.latest(counts.sparkSession).parts.get(_STREAM, {})) - {stream}
    if owners:
        raise ValueError(f"{path} belongs to another stream: its checkpoint is not {checkpoint}")

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        draft = store.begin(spark)
        done = draft.base.parts.get(_STREAM, {})
        if set(done) - {stream}:
            raise ValueError(f"{path} belongs to another stream")
        if stream in done and batch_id <= done[stream][1]:
            return
        marked = batch.withColumn("batch", F.lit(batch_id).cast("long"))
        draft.write_part(_LOG, f"0-{batch_id:08d}", marked)
        level = 0
        while True:
            now = draft.current
            parts = sorted(p for p in now.parts[_LOG] if p.startswith(f"{level}-"))
            if len(parts) < MERGE:
                break
            draft.write_part(_LOG, f"{level + 1}-{batch_id:08d}", _newest(now.read(spark, _LOG, marked.schema, parts)).select(*marked.columns))
            for part in parts:
                draft.remove(_LOG, part)
            level += 1
        draft.mark(_STREAM, stream, batch_id)
        draft.publish()

    return _each_batch(counts, checkpoint, work, "update", available_now)


def latest_counts(spark: SparkSession, path: str, keys: str) -> DataFrame:
    """Newest count of each key; ``keys`` declares the key columns."""
    schema = spark.createDataFrame([], f"{keys}, n long, batch long").schema
    return _newest(Store(path).latest(spark).read(spark, _LOG, schema)).drop("batch")


def keep_totals(feedback: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    return keep_counts(customer_totals(feedback), path, checkpoint, available_now)


def latest_totals(spark: SparkSession, path: str) -> DataFrame:
    return latest_counts(spark, path, "customer_id string")


# --- Prediction counters ------------------------------------------------------------

def tier_counts(scored: DataFrame, score: str = "score", time: str = "event_ts", width: str = "1 day") -> DataFrame:
    """(window_start, priority_tier, mode, n) of scored leads, late ones included."""
    keys = (F.window(time, width), priority_tier(F.col(score)).alias("priority_tier"), F.col("mode"))
    counts = scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), "priority_tier", "mode", "n")


def latency_histogram(df: DataFrame, seconds: str = "latency") -> DataFrame:
    """One row: cumulative counts per upper bound, all requests, sum of seconds."""
    value = F.col(seconds)
    bounds = [F.count(F.when(value <= b, 1)).alias(f"le_{str(b).replace('.', '_')}") for b in LATENCY_BUCKETS]
    return df.groupBy().agg(*bounds, F.count(F.lit(1)).alias("le_inf"), F.sum(value).alias("total_seconds"))


def keep_whole_result(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Complete-mode result of a small aggregate, rewritten by each batch."""

    def work(batch: DataFrame, batch_id: int) -> None:
        overwrite_table(batch, path)

    return _each_batch(df, checkpoint, work, "complete", available_now)


# --- Drift and scoring ----------------------------------------------------------------

def watch_drift(incoming: DataFrame, edges: dict[str, list[float]], expected_path: str, path: str, checkpoint: str,
                columns=DRIFT_FEATURES, available_now: bool = True) -> StreamingQuery:
    """Drift report of each batch against a baseline profiled once: its edges and its counts per bin."""

    def work(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            expected = batch.sparkSession.read.parquet(expected_path)
            report = drift.drift_report(None, batch, columns, edges=edges, expected=expected)
            append_batch(report, path, f"{stream_name(checkpoint)}-{batch_id:08d}")

    return _each_batch(incoming, checkpoint, work, available_now=available_now)


def drift_alerts(reports: DataFrame) -> DataFrame:
    """Batches seen and batches with at least one drifted feature."""
    per_batch = reports.groupBy("_batch_id").agg(F.max("is_drifted").alias("drifted"))
    return per_batch.agg(F.count(F.lit(1)).alias("batches"), F.count(F.when(F.col("drifted"), 1)).alias("alerts"))


def score(leads: DataFrame, models: Mapping[str, TrainedModel], path: str, checkpoint: str,
          settings: Settings = DEFAULT, available_now: bool = True, explain: bool = False) -> StreamingQuery:
    """Leads scored (and explained) as they arrive, by the same plan as a batch."""
    return to_parquet(score_leads(leads, dict(models), settings, explain=explain), path, checkpoint, available_now)
