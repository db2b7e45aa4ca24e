"""Literal cases, edge values and refusals."""

import hashlib
import hmac
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadlake import config
from leadlake.config import Contracts
from leadlake.functions import encode, features, hashing, numeric, text
from leadlake.operators import bins, conform, contracts, drift, evaluate, fairness, marts, prep, privacy, profile, score, stats
from leadlake.plans import fixtures as fx
from leadlake.plans import lakehouse
from leadlake.schemas import LEADS, as_text
from leadlake.session import shared_dir
from leadlake.sources import readers, sinks

GOOD = dict(customer_id="CUST_00001", phone="0912345678", age=40, job="management", marital="married", education="tertiary",
            default="no", balance=2375.5, housing="yes", loan="no", contact="cellular", day=5, month="may", duration=120.0,
            campaign=1, pdays=-1, previous=0, poutcome="unknown", y="no", src_key=1)


def leads(spark, *changes):
    return spark.createDataFrame([tuple({**GOOD, **c}[f.name] for f in LEADS) for c in changes], LEADS)


def one(df):
    (row,) = df.collect()
    return row


# --- contracts ------------------------------------------------------------------

def test_negative_duration_is_quarantined_with_reason(spark):
    valid, bad = contracts.split(leads(spark, {}, {"duration": -50.0}), contracts.bronze_rules())
    assert valid.count() == 1
    assert one(bad)[contracts.REASON] == "duration_range"


@pytest.mark.parametrize("column", ["age", "duration", "campaign"])
def test_missing_value_lands_in_quarantine_and_is_not_lost(spark, column):
    valid, bad = contracts.split(leads(spark, {}, {column: None}), contracts.bronze_rules())
    assert (valid.count(), bad.count()) == (1, 1)


def test_text_in_a_number_quarantines_its_row_only(spark):
    raw = spark.createDataFrame([("30", "5", "1", "1", "-1", "0"), ("thirty", "5", "1", "1", "-1", "0"),
                                 ("30", "NaN", "x", "1", "-1", "0")], "age string, balance string, duration string, "
                                "campaign string, pdays string, previous string")
    valid, bad = contracts.split(raw, contracts.bronze_rules())
    assert valid.count() == 1
    assert {r[contracts.REASON] for r in bad.collect()} == {"age_range", "balance_number; duration_range"}


def test_age_limits(spark):
    rows = leads(spark, *[{"age": a} for a in (17, 18, 105, 106)])
    assert {r.age for r in contracts.split(rows, contracts.bronze_rules())[0].collect()} == {18, 105}


def test_lead_of_age_15_is_rejected(spark):
    _, bad = contracts.split(leads(spark, {"age": 15}), contracts.lead_rules())
    assert one(bad)[contracts.REASON] == "age_range"


def test_missing_column_raises(spark):
    with pytest.raises(ValueError, match="campaign"):
        contracts.require_columns(leads(spark, {}).drop("campaign"))


def test_ratio_gate_raises_only_above_the_limit():
    contracts.enforce_ratio(100, 10)
    with pytest.raises(contracts.QuarantineLimitExceeded):
        contracts.enforce_ratio(100, 11)


def test_silver_contracts_pass_on_good_rows(spark):
    df = leads(spark, {}).withColumn("interaction_id", F.lit("INT_1"))
    for rules in (contracts.customer_rules(), contracts.interaction_rules()):
        assert {r.violations for r in contracts.violation_counts(df, rules).collect()} == {0}


# --- features ---------------------------------------------------------------------

def test_derived_features_of_the_known_lead(spark):
    row = one(features.derive_leads(leads(spark, dict(
        balance=7140.0, housing="yes", loan=" YES ", campaign=6, previous=3, pdays=22, poutcome="Success"))))
    assert (row.balance_tier, row.financial_pressure_index, row.campaign_pressure_ratio, row.is_previously_contacted,
            row.past_success_flag, row.pdays_group) == ("high_5k_plus", 2, 1.5, 1, 1, "recent_le_30d")


@pytest.mark.parametrize("balance,tier", [(-0.01, "negative"), (0.0, "low_0_1k"), (1000.0, "low_0_1k"), (1000.5, "mid_1k_5k"),
                                          (5000.0, "mid_1k_5k"), (5000.01, "high_5k_plus"), (None, None), (math.nan, None)])
def test_balance_tier_has_no_gap(spark, balance, tier):
    df = spark.createDataFrame([(balance,)], "b double")
    assert one(df.select(features.balance_tier(F.col("b")).alias("t"))).t == tier


def test_defaults_for_missing_columns_and_values(spark):
    row = one(features.fill_lead_defaults(leads(spark, {"duration": None}).drop("month", "customer_id")))
    assert (row.month, row.customer_id, row.duration) == ("may", "ANONYMOUS", 0.0)


def test_ids_keep_their_case(spark):
    row = one(text.clean_strings(leads(spark, {"customer_id": " Cust_A ", "job": " ADMIN. "})))
    assert (row.customer_id, row.job) == ("Cust_A", "admin.")


def test_colliding_names_are_refused(spark):
    with pytest.raises(ValueError, match="age"):
        text.normalise_names(spark.createDataFrame([(1, 2)], "` Age` int, age int"))


def test_target_month_and_clip(spark):
    df = spark.createDataFrame([("2", "MAY", 5.0), ("no", "xyz", None), ("?", None, -9.0)], "y string, m string, v double")
    rows = df.select(encode.target_flag(F.col("y")), encode.month_number(F.col("m")),
                     numeric.clip(F.col("v"), F.lit(0.0), F.lit(1.0))).collect()
    assert [tuple(r) for r in rows] == [(1, 5, 1.0), (0, None, None), (None, None, 0.0)]


# --- privacy ------------------------------------------------------------------------

def test_token_is_standard_hmac(spark):
    for salt in ("short", "k" * 64, "longer than one block " * 8):
        want = "TOKEN_" + hmac.new(salt.encode(), b"CUST_00123", hashlib.sha256).hexdigest()[:16]
        df = spark.createDataFrame([("CUST_00123",), ("CUST_00123",), ("",), (None,)], "id string")
        got = [r.t for r in df.select(hashing.token(F.col("id"), salt).alias("t")).collect()]
        assert got == [want, want, "ANONYMOUS", "ANONYMOUS"]


def test_salt_is_required():
    with pytest.raises(ValueError):
        hashing.token(F.lit("x"), "")


def test_phone_mask(spark):
    df = spark.createDataFrame([("0912345678",), ("123456",), (None,), ("1234567",)], "p string")
    assert [r.m for r in df.select(text.mask_phone(F.col("p")).alias("m")).collect()] == ["091****678", "****", "****", "123****567"]


def test_deidentified_balances_are_bands(spark):
    out = privacy.deidentify(leads(spark, {"balance": 1730.0}, {"balance": 4420.0}, {"balance": -1.0}), "s", mask_financials=True)
    rows = out.collect()
    assert [r.balance for r in rows] == [1500.0, 4000.0, -500.0]
    assert all(r.customer_id.startswith("TOKEN_") for r in rows)


# --- dimension, fact, joins -----------------------------------------------------------

def test_latest_customer_and_first_interaction_win(spark):
    rows = leads(spark, {"balance": 1.0, "src_key": 1, "previous": 0}, {"balance": 2.0, "src_key": 2, "previous": 7})
    assert one(conform.build_dim_customer(rows, ("src_key",))).balance == 2.0
    fact = one(conform.build_fact_interaction(rows, ("src_key",)))
    assert fact.previous == 0 and fact.interaction_id.startswith("INT_")


def test_result_does_not_depend_on_partitioning(spark, sf):
    from leadlake.plans import fixtures as fx

    rows = fx.leads_dup(spark, sf)
    order = ("event_ts", "src_key")
    want = sorted(map(str, conform.build_dim_customer(rows, order).collect()))
    shuffled = rows.repartition(7, F.rand(3)).sortWithinPartitions(F.rand(5))
    assert sorted(map(str, conform.build_dim_customer(shuffled, order).collect())) == want


def test_fact_without_label_column(spark):
    fact = conform.build_fact_interaction(leads(spark, {}).drop("y"), ("src_key",))
    assert one(fact).y is None
    assert one(marts.campaign_performance(fact)).total_conversions == 0


def test_audit_generates_missing_ids(spark):
    rows = conform.add_audit(leads(spark, {}, {"age": 41}).drop("customer_id"), "b1", "f.csv").collect()
    assert len({r.customer_id for r in rows}) == 2 and all(r.customer_id.startswith("CUST_b1_") for r in rows)


def test_equal_leads_without_id_stay_apart(spark):
    same = leads(spark, *[{}] * 3, {"age": 41}).drop("customer_id", "src_key")
    rows = conform.add_audit(same, "b1", "f.csv").collect()
    assert len(rows) == 4 and len({r.customer_id for r in rows}) == 4
    again = conform.add_audit(same.repartition(3), "b1", "f.csv").collect()
    assert {r.customer_id for r in again} == {r.customer_id for r in rows}
    assert conform.build_dim_customer(conform.add_audit(same, "b1", "f.csv")).count() == 4


def test_settings_from_a_file(tmp_path):
    path = tmp_path / "settings.toml"
    path.write_text('[economics]\ncall_cost = 4\n[tiers]\nbounds = [0.8, 0.5, 0.2]\n[contracts]\nenforce_ratio = true\n')
    loaded = config.load_settings(str(path))
    assert loaded.economics.call_cost == 4.0 and loaded.economics.deposit_profit == config.DEFAULT.economics.deposit_profit
    assert loaded.tiers.bounds == (0.8, 0.5, 0.2) and loaded.contracts.enforce_ratio and loaded.split == config.DEFAULT.split
    for text in ("[economy]\na = 1\n", "[economics]\ncosts = 1.0\n", '[economics]\ncall_cost = "4"\n', "economics = 3\n", "[training]\nseed = true\n"):
        path.write_text(text)
        with pytest.raises(ValueError):
            config.load_settings(str(path))


def test_record_hash_does_not_depend_on_float_text(spark):
    rows = leads(spark, {"balance": 12345678.0}, {"balance": None}).select(hashing.record_hash().alias("h")).collect()
    assert rows[0].h == hashlib.md5(b"40.0000000000_management_12345678.0000000000_5.0000000000_may").hexdigest()
    assert rows[1].h == hashlib.md5(b"40.0000000000_management_~_5.0000000000_may").hexdigest()


# --- statistics -------------------------------------------------------------------------

def test_quantile_edges_merge_and_bins_match_hand_count(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 1, 2, 3, 4, 5]], "v double")
    edges = bins.quantile_edges(df, "v", 4)
    assert edges == [1.0, 1.5, 3.25, 5.0]
    got = [r.b for r in df.select(bins.quantile_bin(F.col("v"), edges).alias("b")).collect()]
    assert got == [0, 0, 0, 0, 1, 1, 2, 2]


def test_fixed_bins_at_the_edges(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (59.9,), (60.0,), (1e9,), (None,), (math.nan,)], "v double")
    got = [r.b for r in df.select(bins.fixed_bin(F.col("v"), (0.0, 60.0, math.inf)).alias("b")).collect()]
    assert got == [None, 0, 0, 1, 1, None, None]


def test_describe_ignores_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,), (math.nan,)], "v double")
    row = one(profile.describe_numeric(df, ["v"]))
    assert (row["count"], row["min"], row["q50"], row["max"]) == (3, 1.0, 2.0, 4.0)
    assert row["q25"] == pytest.approx(1.5)


def test_chi_square_tails():
    assert stats._chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert stats._chi_square_tail(5.991464547107979, 2) == pytest.approx(0.05, abs=1e-9)
    assert stats._chi_square_tail(7.814727903251179, 3) == pytest.approx(0.05, abs=1e-9)
    assert stats._chi_square_tail(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-9)
    assert stats._chi_square_tail(5000.0, 400) == pytest.approx(0.0, abs=1e-12)
    assert stats._chi_square_tail(0.0, 5) == 1.0


def test_mann_whitney_against_pairs(spark):
    a, b = [1.0, 2.0, 2.0, 5.0], [2.0, 3.0, 9.0]
    df = spark.createDataFrame([(v, 0) for v in a] + [(v, 1) for v in b], "v double, label int")
    want = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert one(stats.mann_whitney(df, ["v"], "label")).u == pytest.approx(want)


def test_chi_square_with_an_empty_cell(spark):
    df = spark.createDataFrame([("a", "x")] * 3 + [("b", "y")] * 4 + [("c", "x")] * 5, "p string, q string")
    row = one(stats.chi_square(df, "p", "q"))
    assert row.statistic == pytest.approx(12.0) and row.dof == 2


def test_extremes_break_ties_by_key(spark):
    df = spark.createDataFrame([(2, 1.0), (1, 1.0), (3, 9.0), (4, 9.0)], "k int, v double")
    rows = {r.extreme: r.k for r in stats.extreme_rows(df, ["v"], "k").collect()}
    assert rows == {"min v": 1, "max v": 3}


# --- evaluation -------------------------------------------------------------------------

def scores(spark, pairs):
    return spark.createDataFrame(pairs, "label int, score double")


def test_single_class_and_constant_scores(spark):
    all_no = scores(spark, [(0, 0.5)] * 4)
    row = one(evaluate.evaluate(all_no, 0.5))
    assert row.roc_auc is None and row.pr_auc == 0.0 and row.f1_score == 0.0
    assert one(evaluate.roc_auc(scores(spark, [(0, 0.5), (1, 0.5)]))).roc_auc == 0.5


def test_best_threshold_takes_the_lowest_on_ties(spark):
    row = one(evaluate.best_thresholds(evaluate.threshold_curve(scores(spark, [(1, 0.9), (0, 0.2)]))))
    assert row.optimal_threshold_f1 == 0.21 and row.optimal_threshold_profit == 0.21


def test_confusion_keeps_empty_cells(spark):
    assert {(r.actual, r.predicted): r.n for r in evaluate.confusion(scores(spark, [(1, 0.9)]), 0.5).collect()} == {
        (0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 1}


def test_tier_bounds_and_action(spark):
    df = scores(spark, [(0, s) for s in (0.70, 0.6999, 0.45, 0.25, 0.2499)] + [(0, None)])
    tier = score.priority_tier(F.col("score"))
    got = [r.t[:6] if r.t else None for r in df.select(tier.alias("t")).collect()]
    assert got == ["Tier 1", "Tier 2", "Tier 2", "Tier 3", "Tier 4", None]
    assert df.select(score.tier_action(tier).alias("a")).filter("a IS NULL").count() == 1


# --- drift, fairness -----------------------------------------------------------------------

BASE = [23, 29, 34, 38, 47, 52, 58, 63]


def frame(spark, ages, balance=0.0):
    return spark.createDataFrame([(a, float(i * 100 + balance)) for i, a in enumerate(ages)], "age int, balance double")


def test_copy_is_stable_and_shift_is_found(spark):
    base = frame(spark, BASE)
    same = drift.drift_report(base, frame(spark, BASE)).collect()
    assert {r.psi for r in same} == {0.0} and not same[0].drift_detected and same[0].features_evaluated == 2
    moved = drift.drift_report(base, frame(spark, [75, 78, 80, 82, 85, 88, 90, 92], 9000.0)).collect()
    assert all(r.drift_detected and r.status == "SIGNIFICANT_DRIFT" for r in moved)


def test_column_without_numbers_is_counted_but_not_reported(spark):
    base, empty = frame(spark, BASE), frame(spark, BASE).withColumn("balance", F.lit(None).cast("double"))
    rows = drift.drift_report(base, empty).collect()
    assert [r.feature for r in rows] == ["age"] and rows[0].features_evaluated == 2


def test_drift_without_baseline_raises(spark):
    with pytest.raises(ValueError):
        drift.drift_report(frame(spark, BASE).limit(0), frame(spark, BASE))


def test_constant_baseline(spark):
    rows = drift.psi_by_feature(frame(spark, [40] * 8), frame(spark, [40] * 8), ["age"]).collect()
    assert [r.psi for r in rows] == [0.0]


def test_fairness_edges(spark):
    df = spark.createDataFrame([(70, 1, 1), (30, 1, 0), (30, 0, 0)], "age int, label int, decision int")
    row = one(fairness.audit(df, ["age"], "label", "decision"))
    assert row.disparate_impact_ratio == 1.0  # nobody privileged was favoured
    assert row.equal_opportunity_difference == 1.0 and row.status == "REQUIRES_MITIGATION"
    only_skipped = fairness.audit(df, ["income"], "label", "decision")
    assert one(only_skipped).status == "SKIPPED"


# --- preparation -----------------------------------------------------------------------------

def test_constant_column_is_only_centred(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 3.0)], "a double, b double")
    rows = prep.Scaler.fit(df, ["a", "b"]).transform(df).collect()
    assert {r.a for r in rows} == {0.0}
    assert rows[0].b == pytest.approx(-1.0 / 0.816496580927726)


def test_too_many_levels_are_refused_not_cut(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="levels"):
        prep.category_levels(df, ["c"], max_levels=10)


def test_split_keeps_customers_together(spark, sf):
    from leadlake.plans import fixtures as fx

    parts = prep.assign_split(fx.leads_raw(spark, sf), "customer_id")
    assert parts.groupBy("customer_id").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0


def test_exact_split_shares(spark):
    df = spark.range(1000).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))
    counts = {(r.label, r.split): r["count"] for r in prep.assign_split_exact(df, "id", "label").groupBy("label", "split").count().collect()}
    assert counts == {(0, "train"): 487, (0, "validation"): 113, (0, "test"): 150,
                      (1, "train"): 162, (1, "validation"): 38, (1, "test"): 50}


def test_smote_balances_and_stays_on_segments(spark):
    rows = [(i, 0, float(i), float(i % 7)) for i in range(60)] + [(100 + i, 1, 100.0 + i, 50.0) for i in range(9)]
    df = spark.createDataFrame(rows, "id int, label int, a double, b double")
    out = prep.smote(df, ["a", "b"], "label", "id").collect()
    made = [r for r in out if r.is_synthetic]
    assert len(out) == 120 and len(made) == 51
    assert all(r.label == 1 and r.b == 50.0 and 100.0 <= r.a <= 108.0 for r in made)
    # within the five nearest: at most five steps away from its own row
    assert all(abs(r.a - (r.id)) <= 5.0 for r in made)
    again = prep.smote(df.repartition(5), ["a", "b"], "label", "id").collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_neighbours_survive_many_copies_of_one_point(spark):
    df = spark.range(3000).select(F.col("id"), F.array(
        F.when(F.col("id") < 2000, 1.0).otherwise(F.col("id").cast("double")), F.lit(0.0)).alias("x"))
    near = prep.nearest_neighbours(df, k=3, cell_rows=200)
    assert near.count() == 3000
    assert near.filter(F.size("neighbours") != 3).count() == 0


# --- sources, sinks, runs ----------------------------------------------------------------------

def test_arff_single_file(spark):
    path = shared_dir(spark, "arff")
    body = "% c\n@relation r\n@attribute 'V1' numeric\n@attribute Class {'1','2'}\n@data\n58,'1'\n?,'2'\n"
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(path)
    rows = readers.read_arff(spark, path).collect()
    assert [(r.V1, r.Class) for r in rows] == [(58.0, "1"), (None, "2")]


def test_arff_rows_behind_a_long_header_and_in_many_files(spark):
    """More header lines than any prefix holds, rows that look like header lines, files with and without a header."""
    path = shared_dir(spark, "arff")
    header = ["@relation r", *[f"% note {i}" for i in range(6000)], "@attribute a numeric", "@attribute b string", "@data"]
    files = {"one": [*header, "1,x", "@attribute,odd"], "two": ["2,y", "3,@data"], "three": [*header, "4,z"]}
    for name, text in files.items():
        spark.createDataFrame([("\n".join(text),)], "value string").coalesce(1).write.text(f"{path}/{name}")
    rows = readers.read_arff(spark, f"{path}/*", header_path=f"{path}/one").collect()
    assert sorted((r.a, r.b) for r in rows if r.a is not None) == [(1.0, "x"), (2.0, "y"), (3.0, "@data"), (4.0, "z")]
    assert [r.b for r in rows if r.a is None] == ["odd"]


def test_corrupt_csv_rows_are_kept(spark):
    path = shared_dir(spark, "csv")
    spark.createDataFrame([("a,b\n1,2\nx,3\n",)], "value string").coalesce(1).write.text(path)
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    rows = readers.read_csv(spark, path, schema, keep_corrupt=True).cache().collect()
    assert [r[readers.CORRUPT] for r in rows] == [None, "x,3"]


def test_repeated_batch_replaces_itself(spark):
    layers = lakehouse.Layers(shared_dir(spark, "lake"))
    for _ in range(2):
        out = lakehouse.ingest_frame(leads(spark, {}, {"age": 3}), layers, "b1")
    assert out == {"batch_id": "b1", "ingested_records": 1, "quarantined_records": 1}
    assert lakehouse.read_side(spark, layers.bronze).count() == 1
    assert lakehouse.read_side(spark, layers.bronze, lakehouse.BAD).count() == 1


def test_gate_stops_a_bad_batch_before_it_is_written(spark):
    from leadlake.config import Settings

    layers = lakehouse.Layers(shared_dir(spark, "lake"))
    strict = Settings(contracts=Contracts(enforce_ratio=True))
    with pytest.raises(contracts.QuarantineLimitExceeded):
        lakehouse.ingest_frame(leads(spark, {}, {"age": 3}), layers, "b1", strict)
    with pytest.raises(Exception):
        spark.read.parquet(layers.bronze)


def test_quarantine_can_be_counted_without_being_kept(spark):
    from leadlake.config import Settings

    layers = lakehouse.Layers(shared_dir(spark, "lake"))
    out = lakehouse.ingest_frame(leads(spark, {}, {"age": 3}), layers, "b1", Settings(contracts=Contracts(write_quarantine=False)))
    assert out["quarantined_records"] == 1
    assert lakehouse.read_side(spark, layers.bronze, lakehouse.BAD).count() == 0


def test_csv_file_with_text_in_numbers(spark):
    layers, path = lakehouse.Layers(shared_dir(spark, "lake")), shared_dir(spark, "raw")
    raw = leads(spark, {}, {"src_key": 2}).select(*[F.col(f.name).cast("string") for f in as_text(LEADS)])
    sinks.write_csv(raw.withColumn("age", F.when(F.col("src_key") == "2", "old").otherwise(F.col("age"))), path)
    out = lakehouse.ingest_file(spark, path, layers, "b1")
    assert (out["ingested_records"], out["quarantined_records"]) == (1, 1)
    row = one(lakehouse.read_side(spark, layers.bronze))
    assert row.age == 40 and row._source_file.endswith(".csv")


def test_silver_without_bronze_raises(spark):
    layers = lakehouse.Layers(shared_dir(spark, "lake"))
    lakehouse.ingest_frame(leads(spark, {"age": 3}), layers, "b1")
    with pytest.raises(ValueError):
        lakehouse.build_silver(spark, layers, ("src_key",))


def test_silver_violations_go_to_quarantine(spark):
    layers = lakehouse.Layers(shared_dir(spark, "lake"))
    lakehouse.ingest_frame(leads(spark, {}, {"customer_id": "C2", "job": "astronaut"}), layers, "b1")
    counts = lakehouse.build_silver(spark, layers, ("src_key",))
    assert counts == {"dim_customer_count": 1, "fact_interaction_count": 2}
    assert one(lakehouse.read_side(spark, layers.dim, lakehouse.BAD))[contracts.REASON] == "job_domain"


def test_csv_columns_are_found_by_name(spark, tmp_path):
    schema = StructType([LEADS[c] for c in ("age", "job", "balance")])
    (tmp_path / "a.csv").write_text("Balance,extra,age\n1.5,x,40\n,y,41\n")
    df = readers.read_csv(spark, str(tmp_path / "a.csv"), schema)
    assert df.dtypes == [("Balance", "double"), ("extra", "string"), ("age", "int")]
    assert [tuple(r) for r in df.collect()] == [(1.5, "x", 40), (None, "y", 41)]


def test_csv_files_with_differing_headers_are_one_table(spark, tmp_path):
    """Order, spelling and number of columns differ by file; a column that a file lacks is NULL in its rows."""
    schema = StructType([LEADS[c] for c in ("age", "job", "balance")])
    texts = {"a b": "Balance,extra,age\n1.5,x,40\n", "b": "age,extra,Balance\n41,y,2.5\n43,v,\n", "c": "AGE,job\n42,clerk\n", "d": "Balance,extra,age\n3.5,z,44\n",
             "empty": ""}
    for name, body in texts.items():
        (tmp_path / f"{name}.csv").write_text(body)
    rows = readers.read_csv(spark, str(tmp_path), schema).collect()
    found = sorted((r.age, r.balance, r.extra, r.job) for r in rows)
    assert found == [(40, 1.5, "x", None), (41, 2.5, "y", None), (42, None, None, "clerk"), (43, None, "v", None), (44, 3.5, "z", None)]
    assert readers.read_csv(spark, str(tmp_path), schema).schema["age"].dataType.simpleString() == "int"


def test_scoring_refuses_a_mode_without_a_model(spark, sf):
    from leadlake.plans import lakehouse

    with pytest.raises(ValueError, match="post_call"):
        lakehouse.score_leads(fx.leads_raw(spark, sf), {"pre_call": None})


def test_smaller_redelivery_replaces_both_sides(spark, sf):
    from leadlake.plans import lakehouse
    from leadlake.session import shared_dir

    layers, raw = lakehouse.Layers(shared_dir(spark, "lake")), fx.leads_raw(spark, sf)
    first = lakehouse.ingest_frame(raw, layers, "b1")
    assert first["quarantined_records"] > 0
    good = raw.filter("age BETWEEN 18 AND 100 AND duration >= 0 AND campaign >= 1").limit(50)
    again = lakehouse.ingest_frame(good, layers, "b1")
    bronze = spark.read.parquet(layers.bronze)
    assert bronze.count() == again["ingested_records"] + again["quarantined_records"] == 50


def test_many_edges_are_searched_like_few(spark):
    import bisect
    import random

    rng = random.Random(3)
    for n in (33, 100, 1000):
        edges = sorted(rng.sample(range(10 * n), n))
        values = [None, -1.0, 0.5, *edges[:5], *edges[-3:], *[rng.uniform(-5, 10 * n + 5) for _ in range(50)]]
        df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
        rows = df.select("v", numeric.bucket_index(F.col("v"), edges).alias("a"), numeric.bucket_index(F.col("v"), edges, False).alias("b"))
        for r in rows.collect():
            want = (None, None) if r.v is None else (bisect.bisect_right(edges, r.v), bisect.bisect_left(edges, r.v))
            assert (r.a, r.b) == want


def test_rank_first_bins_with_text_keys(spark):
    df = spark.createDataFrame([(float(i % 3), f"k{i}") for i in range(90)], "v double, k string")
    rows = bins.rank_first_bins(df, "v", "k", 9).groupBy("bin").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    assert sorted((r.bin, r.n, r.lo, r.hi) for r in rows) == [(i, 10, float(i // 3), float(i // 3)) for i in range(9)]
