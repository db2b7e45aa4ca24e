"""Customer dimension, interaction fact and the joins between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake import config as cfg
from leadlake.functions.hashing import record_hash, surrogate_id
from leadlake.functions.text import clean_strings
from leadlake.operators import skew
from leadlake.operators.prep import numbered

AUDIT_ORDER = ("_ingested_at", "_record_hash")


def file_name() -> Column:
    """Name of the file a row was read from; only for frames that come from one source."""
    return F.element_at(F.split(F.input_file_name(), "/"), -1)


def add_audit(df: DataFrame, batch_id: str, source: str | Column) -> DataFrame:
    """Batch, ingestion time, source and record hash; a customer id when the batch carries none.

    The id comes from all columns of the lead. Leads that are equal in all of them stay apart by the number of the copy: equal
    rows are counted (and so combined before the shuffle) and dealt out again with their numbers.
    """
    name = F.lit(source) if isinstance(source, str) else source
    out = df.withColumns({"_batch_id": F.lit(batch_id), "_source_file": name})
    if "customer_id" not in df.columns:
        numbers = [f.name for f in df.schema if f.dataType.simpleString() in ("int", "double", "bigint")]
        counted = out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("_copies"))
        most = counted.agg(F.max("_copies").alias("n")).first().n or 1
        own = surrogate_id(f"CUST_{batch_id}_", df.columns, numbers)
        copies = numbered(counted.withColumn("_own", own), F.col("_copies"), most, "_own", "_copy")
        out = copies.withColumn("customer_id", F.concat_ws("_", "_own", F.when(F.col("_copy") > 1, F.col("_copy").cast("string")))).drop(
            "_copies", "_own", "_copy")
    return out.withColumns({"_ingested_at": F.current_timestamp(), "_record_hash": record_hash()})


def _pick(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str], latest: bool) -> DataFrame:
    """One row per key by an aggregate: combines map-side, so repeated keys shrink before the shuffle.

    Rows that are equal in ``order`` are told apart by all kept columns: the result does not depend on row order.
    """
    chooser = F.max_by if latest else F.min_by
    kept = [c for c in columns if c not in keys]
    best = chooser(F.struct(*kept), F.struct(*order, *[c for c in kept if c not in order])).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*")


def _with_state(state: DataFrame | None, rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows to pick from: new deliveries, and what earlier ones were reduced to. One aggregate over both picks what one over
    each and a third over their results would."""
    if state is None:
        return rows
    kept = [*keys, *[c for c in columns if c not in keys]]
    return state.select(*kept).unionByName(rows.select(*kept))


def build_dim_customer(
    bronze: DataFrame, order: Sequence[str] = AUDIT_ORDER, carry: Sequence[str] = (), state: DataFrame | None = None
) -> DataFrame:
    """Latest state of each customer, typed to the contract. ``carry`` names further columns to keep. ``state`` is the dimension
    of earlier deliveries, which carries ``order``."""
    typed = {"age": F.col("age").cast("int"), "balance": F.col("balance").cast("double")}
    rows, columns = clean_strings(bronze), [*cfg.CUSTOMER_COLUMNS, *carry]
    if state is not None:
        rows = _with_state(state, rows.withColumns(typed), ["customer_id"], columns)
    return _pick(rows, ["customer_id"], columns, order, latest=True).withColumns(typed)


def build_fact_interaction(
    bronze: DataFrame, order: Sequence[str] = AUDIT_ORDER, carry: Sequence[str] = (), state: DataFrame | None = None
) -> DataFrame:
    """First delivery of each distinct interaction, with an id made from its natural key.

    ``carry`` names further columns to keep, such as the ingestion time. ``state`` is the fact of earlier deliveries, which
    carries ``order``; ids are made after the shuffle, as they are most of a row and follow from the key.
    """
    cleaned = clean_strings(bronze)
    if "y" not in cleaned.columns:
        cleaned = cleaned.withColumn("y", F.lit(None).cast("string"))
    typed = cleaned.withColumns({
        **{c: F.col(c).cast("int") for c in ("day", "campaign", "pdays", "previous")},
        "duration": F.col("duration").cast("double"),
    })
    columns = [*cfg.INTERACTION_COLUMNS, *carry]
    picked = _pick(_with_state(state, typed, cfg.INTERACTION_KEY, columns), cfg.INTERACTION_KEY, columns, order, latest=False)
    number = surrogate_id("INT_", cfg.INTERACTION_KEY, numbers=("duration",))
    return picked.withColumn("interaction_id", number)


def join_dim_fact(dim: DataFrame, fact: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Each interaction with its customer. No hint: the dimension grows with the data, so the size decides between
    broadcast and sort-merge at run time. A hot customer is split by the adaptive skew join where both sides come from written
    tables (as in the Gold run); where they come from aggregates, ``counted`` (rows to count customers in) lets the join cut
    hot customers into pieces itself."""
    if counted is None:
        return fact.join(dim, "customer_id", "inner")
    return skew.join(fact, dim, "customer_id", cfg.INTERACTION_KEY[1:], counted=counted)


def lookup_features(ids: DataFrame, features_latest: DataFrame) -> DataFrame:
    return ids.join(features_latest, "customer_id", "left")


def missing_features(ids: DataFrame, features_latest: DataFrame) -> DataFrame:
    return ids.join(features_latest.select("customer_id"), "customer_id", "left_anti")


def latest_features(features: DataFrame, order: Sequence[str]) -> DataFrame:
    return _pick(features, ["customer_id"], features.columns, order, latest=True)


def latest_feedback(feedback: DataFrame) -> DataFrame:
    """Last outcome of each customer as a yes/no label."""
    return feedback.groupBy("customer_id").agg(
        F.max_by("outcome", F.struct("recorded_at", "feedback_id")).alias("outcome")
    ).select("customer_id", F.when(F.col("outcome") == "agreed", "yes").otherwise("no").alias("feedback_label"))


def merge_feedback_labels(fact: DataFrame, feedback: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Fact with the label replaced by the customer's latest call outcome where there is one. The outcomes come from an
    aggregate on the customer, so hot customers of the fact (or of ``counted``) are cut into pieces."""
    joined = skew.join(fact, latest_feedback(feedback), "customer_id", cfg.INTERACTION_KEY[1:], "left", counted)
    return joined.withColumn("label", F.coalesce("feedback_label", "y"))
