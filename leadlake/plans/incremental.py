"""Daily runs that touch only what a batch changes, published whole.

Customers fall into hash buckets. Dimension, fact, feature table and the sums behind both marts are kept bucket by bucket in a
snapshot store. A batch is added to Bronze; dimension and fact of the buckets of its customers are picked from their state and
the batch's rows by one aggregate (latest state and first delivery can both be picked from a state), their Gold rows are made anew, and the marts are added up from the
sums of all buckets, which are small. Buckets without news are neither read nor written; readers see the last published
version until the run's audit has passed and all tables change at once.

A batch that is delivered again replaces itself: what it said before cannot be taken out of merged state, so the buckets of
its old and its new rows are rebuilt from all Bronze batches, still only those buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.config import DEFAULT, Settings
from leadlake.operators import conform, contracts, marts
from leadlake.plans.lakehouse import SIDE, VALID, _sided, checked_batch
from leadlake.sources.snapshots import BUCKET, Draft, Snapshot, Store

BRONZE, DIM, FACT, FEATURES = "bronze", "dim_customer", "fact_campaign_interaction", "feature_table"
CAMPAIGN_SUMS, SEGMENT_SUMS = "campaign_sums", "segment_sums"
CAMPAIGN_MART, SEGMENT_MART = "mart_campaign_performance", "mart_customer_segment_conversion"
_ALL = "all"


class AuditFailed(RuntimeError):
    """A run's tables contradict each other; nothing was published."""


@dataclass(frozen=True)
class Lake:
    """A snapshot store with a fixed number of customer buckets and the order of deliveries."""

    root: str
    buckets: int = 64
    order: Sequence[str] = conform.AUDIT_ORDER

    @property
    def store(self) -> Store:
        return Store(self.root)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.trim(F.col("customer_id").cast("string"))), F.lit(self.buckets)).cast("int")


def _valid(df: DataFrame) -> DataFrame:
    return df.filter(F.col(SIDE) == VALID).drop(SIDE, contracts.REASON)


def _touched(lake: Lake, rows: DataFrame) -> set[int]:
    """Numbers of the buckets that hold the rows' customers: at most as many as there are buckets."""
    return {r.b for r in rows.select(lake.bucket().alias("b")).distinct().collect()}


def _within(lake: Lake, rows: DataFrame, buckets: set[int]) -> DataFrame:
    return rows.filter(lake.bucket().isin(sorted(buckets)))


def _silver(lake: Lake, draft: Draft, rows: DataFrame, state_of: Snapshot | None, touched: set[int],
            settings: Settings) -> dict[str, T.StructType]:
    """Dimension and fact of the touched buckets: from ``rows`` alone, or merged with the state of a snapshot. Returns the
    schemas of what was written."""
    spark, carried, schemas, names = draft.spark, list(lake.order), {}, [str(b) for b in touched]
    stated = (
        (DIM, conform.build_dim_customer, contracts.customer_rules(settings.contracts)),
        (FACT, conform.build_fact_interaction, contracts.interaction_rules()),
    )
    for table, build, rules in stated:
        made = build(rows, lake.order, carried)
        if state_of is not None and state_of.folders(table, names):
            made = build(rows, lake.order, carried, state_of.read(spark, table, made.schema, names)).select(*made.columns)
        checked = _sided(contracts.check(made, rules))
        draft.write_buckets(table, checked.withColumn(BUCKET, lake.bucket()), touched)
        schemas[table] = checked.schema
    return schemas


def _gold(lake: Lake, draft: Draft, touched: set[int], schemas: dict[str, T.StructType]) -> None:
    """Features and sums of the touched buckets, then both marts from the sums of all."""
    spark, names, now = draft.spark, [str(b) for b in touched], draft.current
    dim = _valid(now.read(spark, DIM, schemas[DIM], names)).drop(*lake.order)
    fact = _valid(now.read(spark, FACT, schemas[FACT], names)).drop(*lake.order)
    made = {
        FEATURES: marts.feature_table(dim, fact, ("interaction_id",)).withColumn(BUCKET, lake.bucket()),
        CAMPAIGN_SUMS: marts.campaign_sums(fact.withColumn(BUCKET, lake.bucket()), BUCKET),
        SEGMENT_SUMS: marts.segment_sums(dim.withColumn(BUCKET, lake.bucket()), fact, BUCKET),
    }
    for table, df in made.items():
        draft.write_buckets(table, df, touched)
        schemas[table] = df.drop(BUCKET).schema
    for sums, mart, build in ((CAMPAIGN_SUMS, CAMPAIGN_MART, marts.campaign_from_sums), (SEGMENT_SUMS, SEGMENT_MART, marts.segment_from_sums)):
        draft.write_part(mart, _ALL, build(draft.current.read(spark, sums, schemas[sums])))


def _repeated(rows: DataFrame, key: str) -> bool:
    """Whether a key has several rows. Hashes are shuffled; keys only if two rows have the same hash."""
    for by in (F.xxhash64(key), F.col(key)):
        if rows.groupBy(by.alias("_by")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            return False
    return True


def _audit(draft: Draft, touched: set[int], schemas: dict[str, T.StructType]) -> None:
    """Keys are unique, every interaction is in the sums, and no feature row has come from nowhere. Reads the touched buckets
    only: the others have passed before."""
    spark, names, now = draft.spark, [str(b) for b in touched], draft.current
    for table, key in ((DIM, "customer_id"), (FACT, "interaction_id")):
        rows = now.read(spark, table, schemas[table], names)
        if _repeated(rows, key):
            raise AuditFailed(f"{table}: {key} is not unique")
    valid = _valid(now.read(spark, FACT, schemas[FACT], names)).count()
    calls = now.read(spark, CAMPAIGN_SUMS, schemas[CAMPAIGN_SUMS], names).agg(F.sum("total_calls").alias("n")).first().n or 0
    if calls != valid:
        raise AuditFailed(f"the campaign sums hold {calls} calls, the fact {valid}")
    if now.count(FEATURES, names) > valid:
        raise AuditFailed("more feature rows than interactions")


def run_batch(raw: DataFrame, lake: Lake, batch_id: str, settings: Settings = DEFAULT, source: str | Column = "frame",
              keep_bad: bool = True) -> dict:
    """Ingest one batch and bring all layers up to date. Returns counts and the published version.

    A batch without valid rows changes Bronze only. A run that fails leaves the last version as it was.
    """
    spark = raw.sparkSession
    draft = lake.store.begin(spark)
    before = draft.base
    checked = checked_batch(raw, batch_id, settings, source)
    written = checked if keep_bad else checked.filter(F.col(SIDE) == VALID)
    total = draft.write_part(BRONZE, batch_id, written.drop("_batch_id"))
    news = _valid(draft.current.read(spark, BRONZE, None, [batch_id]))
    touched, again = _touched(lake, news), batch_id in before.parts.get(BRONZE, {})
    if again:
        old = _valid(before.read(spark, BRONZE, None, [batch_id]))
        touched |= _touched(lake, old)
    if touched:
        if again:
            rows = _within(lake, _valid(draft.current.read(spark, BRONZE)), touched)
            schemas = _silver(lake, draft, rows, None, touched, settings)
        else:
            schemas = _silver(lake, draft, news, before, touched, settings)
        _gold(lake, draft, touched, schemas)
        _audit(draft, touched, schemas)
    snapshot = draft.publish()
    return {"batch_id": batch_id, "version": snapshot.version, "bronze_records": total, "touched_buckets": len(touched),
            "dim_records": snapshot.count(DIM), "fact_records": snapshot.count(FACT), "feature_records": snapshot.count(FEATURES)}


def table(spark: SparkSession, lake: Lake, name: str, snapshot: Snapshot | None = None) -> DataFrame:
    """A published table; of the Silver ones the rows that keep their contract."""
    seen = snapshot or lake.store.latest(spark)
    df = seen.read(spark, name)
    return _valid(df) if SIDE in df.columns else df
