"""Registered queries: preparation and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlake.config import Features
from leadlake.functions.text import clean_strings
from leadlake.operators import prep
from leadlake.operators.neighbours import nearest_neighbours
from leadlake.plans import fixtures as fx
from leadlake.plans.catalogue import query, tidy
from leadlake.plans.q_profile import labelled
from leadlake.plans.q_tables import features

_NOMINAL = {
    "marital": ("divorced", "married", "single"),
    "contact": ("cellular", "telephone", "unknown"),
    "poutcome": ("failure", "other", "success", "unknown"),
}


@query("prep_winsorise", """
SELECT src_key, round(CASE WHEN balance < b[1] THEN b[1] WHEN balance > b[2] THEN b[2] ELSE balance END, 4) AS balance,
       round(CASE WHEN duration < d[1] THEN d[1] WHEN duration > d[2] THEN d[2] ELSE duration END, 4) AS duration
FROM leads_raw, (SELECT quantile_cont(balance, [0.01, 0.99]) AS b, quantile_cont(duration, [0.01, 0.99]) AS d FROM leads_raw)""",
       ("leads_raw",))
def prep_winsorise(spark, sf):
    df = fx.leads_raw(spark, sf).select("src_key", "balance", "duration")
    return tidy(prep.winsorise(df, ("balance", "duration")), 4)


@query("prep_one_hot_drop_first", f"""
SELECT src_key, {', '.join(f"CAST({c} = '{v}' AS INTEGER) AS {c}_{v}" for c, vs in _NOMINAL.items() for v in vs[1:])} FROM leads_raw""",
       ("leads_raw",))
def prep_one_hot_drop_first(spark, sf):
    df = fx.leads_raw(spark, sf).select("src_key", *_NOMINAL)
    return prep.one_hot_drop_first(df, prep.category_levels(df, list(_NOMINAL)))


@query("prep_one_hot", f"""
SELECT src_key, concat({', '.join(f"({c} = '{v}')::INT" for c, vs in _NOMINAL.items() for v in vs)}) AS encoded,
       concat({', '.join("(CASE WHEN poutcome = 'other' THEN FALSE ELSE poutcome = '" + v + "' END)::INT" for v in _NOMINAL['poutcome'])}) AS unseen
FROM leads_raw""", ("leads_raw",))
def prep_one_hot(spark, sf):
    df = fx.leads_raw(spark, sf).select("src_key", *_NOMINAL)
    levels = prep.category_levels(df, list(_NOMINAL))
    blocks = F.concat(*[prep.one_hot(F.col(c), v) for c, v in levels.items()])
    strange = F.when(F.col("poutcome") == "other", "never seen").otherwise(F.col("poutcome"))

    def text(array):
        return F.array_join(array.cast("array<string>"), "")

    return df.select("src_key", text(blocks).alias("encoded"), text(prep.one_hot(strange, levels["poutcome"])).alias("unseen"))


_SPLIT = """CASE WHEN u < 0.2 THEN 'test' WHEN u < 0.35 THEN 'validation' ELSE 'train' END"""
_U = "CAST('0x' || substr(md5(concat({key}, '#42')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE"


@query("prep_standardise", f"""
WITH s AS (SELECT *, {_SPLIT} AS split FROM (SELECT *, {_U.format(key='customer_id')} AS u FROM leads_raw)),
m AS (SELECT avg(age) AS ma, stddev_pop(age) AS sa, avg(balance) AS mb, stddev_pop(balance) AS sb FROM s WHERE split = 'train')
SELECT src_key, split, round((age - ma) / sa, 6) AS age, round((balance - mb) / sb, 6) AS balance FROM s, m""", ("leads_raw",))
def prep_standardise(spark, sf):
    df = prep.assign_split(fx.leads_raw(spark, sf), "customer_id")
    scaler = prep.Scaler.fit(df.filter("split = 'train'"), ("age", "balance"))
    return tidy(scaler.transform(df).select("src_key", "split", "age", "balance"))


_BLOCKS = {
    "job": ("admin.", "blue-collar", "entrepreneur", "housemaid", "management", "retired", "self-employed", "services",
            "student", "technician", "unemployed", "unknown"),
    "marital": _NOMINAL["marital"], "housing": ("no", "yes"),
}


@query("prep_assemble", f"""
WITH s AS (SELECT * FROM cleaned), m AS (SELECT avg(age) AS ma, stddev_pop(age) AS sa, avg(balance) AS mb, stddev_pop(balance) AS sb FROM s)
SELECT src_key, event_ts, 0 AS place, round((age - ma) / sa, 5) AS value, 'age' AS name FROM s, m
UNION ALL SELECT src_key, event_ts, 1, round((balance - mb) / sb, 5), 'balance' FROM s, m
{' '.join(f"UNION ALL SELECT src_key, event_ts, {i}, ({c} = '{v}')::INT::DOUBLE, '{c}_{v}' FROM s"
          for i, (c, v) in enumerate([(c, v) for c, vs in _BLOCKS.items() for v in vs], start=2))}""", ("cleaned",))
def prep_assemble(spark, sf):
    from leadlake.plans.q_tables import bronze

    df = clean_strings(bronze(spark, sf))
    encoder = prep.Encoder.fit(df, ("age", "balance"), list(_BLOCKS))
    names = F.array(*[F.lit(n) for n in encoder.names])
    encoded = encoder.transform(df).select("src_key", "event_ts", F.posexplode("features").alias("place", "value"))
    return tidy(encoded.withColumn("name", F.element_at(names, F.col("place") + 1)), 5)


_F = Features()
_MODES = [
    (mode, place, column) for mode in ("pre_call", "post_call")
    for place, column in enumerate([c for c in _F.numerical if mode == "post_call" or c != "duration"] + list(_F.categorical + _F.binary))
]


@query("prep_mode_columns", " UNION ALL ".join(
    f"SELECT '{m}' AS mode, {i} AS place, '{'in_default' if c == 'default' else c}' AS feature, count({'in_default' if c == 'default' else c}) AS n_known FROM features"
    for m, i, c in _MODES), ("features",))
def prep_mode_columns(spark, sf):
    df = features(spark, sf)
    totals = df.agg(*[F.count(c).alias(c) for c in dict.fromkeys(c for _, _, c in _MODES)])
    parts = []
    for mode in ("pre_call", "post_call"):
        numeric, categorical = prep.model_columns(mode)
        columns = [*numeric, *categorical]
        rows = F.array(*[F.struct(
            F.lit(mode).alias("mode"), F.lit(i).alias("place"), F.lit("in_default" if c == "default" else c).alias("feature"),
            F.col(c).alias("n_known")) for i, c in enumerate(columns)])
        parts.append(rows)
    return totals.select(F.explode(F.concat(*parts)).alias("r")).select("r.*")


@query("prep_split", f"""
SELECT src_key, customer_id, {_SPLIT} AS split FROM (SELECT *, {_U.format(key='customer_id')} AS u FROM leads_raw)""", ("leads_raw",))
def prep_split(spark, sf):
    return prep.assign_split(fx.leads_raw(spark, sf), "customer_id").select("src_key", "customer_id", "split")


@query("prep_split_exact", """
SELECT src_key, label, CASE WHEN r <= round(n * 0.2::DOUBLE) THEN 'test' WHEN r <= round(n * 0.35::DOUBLE) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT src_key, (y = 'yes')::INT AS label, count(*) OVER (PARTITION BY y) AS n,
             row_number() OVER (PARTITION BY y ORDER BY md5(concat(src_key, '#42')), src_key) AS r FROM leads_raw)""", ("leads_raw",))
def prep_split_exact(spark, sf):
    df = labelled(spark, sf).select("src_key", "label")
    return prep.assign_split_exact(df, "src_key", "label")


@query("prep_class_weight", """
SELECT src_key, label, round((SELECT count(*) FROM scored) / (2.0::DOUBLE * count(*) OVER (PARTITION BY label)), 6) AS weight FROM scored""",
       ("scored",))
def prep_class_weight(spark, sf):
    return tidy(prep.add_class_weight(fx.scored(spark, sf), "label").select("src_key", "label", "weight"))


@query("prep_null_check", """
SELECT CAST(sum((duration IS NULL)::INT + (age IS NULL)::INT + (balance IS NULL)::INT + (y IS NULL)::INT) AS BIGINT) AS missing_cells,
       sum((duration IS NULL)::INT + (age IS NULL)::INT + (balance IS NULL)::INT + (y IS NULL)::INT) = 0 AS is_clean FROM leads_raw""",
       ("leads_raw",))
def prep_null_check(spark, sf):
    return prep.null_check(fx.leads_raw(spark, sf), ("duration", "age", "balance", "y"))


_PLACES = ("age", "balance / 1000", "duration / 100", "campaign")


def _minority(spark, sf):
    """(id, x) of the complete rows of the smaller class."""
    rows = labelled(spark, sf).filter("label = 1 AND duration IS NOT NULL AND balance IS NOT NULL AND age IS NOT NULL AND campaign IS NOT NULL")
    return rows.select(F.col("src_key").alias("id"), F.array(*[F.expr(f"CAST({p.split(' ')[0]} AS DOUBLE){p[len(p.split(' ')[0]):]}") for p in _PLACES]).alias("x"))


@query("prep_neighbours", f"""
WITH p AS (SELECT src_key, {', '.join(f"CAST({p.split(' ')[0]} AS DOUBLE){p[len(p.split(' ')[0]):]} AS x{i}" for i, p in enumerate(_PLACES))}
           FROM leads_raw WHERE y = 'yes' AND duration IS NOT NULL AND balance IS NOT NULL AND age IS NOT NULL AND campaign IS NOT NULL),
d AS (SELECT a.src_key, {' + '.join(f'(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})' for i in range(len(_PLACES)))} AS d
      FROM p a JOIN p b ON a.src_key <> b.src_key)
SELECT src_key, CAST(row_number() OVER (PARTITION BY src_key ORDER BY d) AS INTEGER) AS place, round(d, 6) AS gap FROM d
QUALIFY row_number() OVER (PARTITION BY src_key ORDER BY d) <= 5""", ("leads_raw",))
def prep_neighbours(spark, sf):
    """Distances of the five nearest rows of the own class; the oracle compares all pairs."""
    near = nearest_neighbours(_minority(spark, sf), 5)
    listed = near.select(F.col("id").alias("src_key"), F.posexplode("neighbours").alias("at", "n"))
    return tidy(listed.select("src_key", (F.col("at") + 1).alias("place"), F.col("n.d").alias("gap")))


_COORDINATES = ("age", "balance", "duration", "campaign")


@query("prep_smote", """
WITH c AS (SELECT *, CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS label FROM leads_raw),
n AS (SELECT count(*) FILTER (label = 0) - count(*) FILTER (label = 1) AS wanted,
             count(*) FILTER (label = 1 AND duration IS NOT NULL AND balance IS NOT NULL AND age IS NOT NULL) AS usable FROM c),
r AS (SELECT src_key, row_number() OVER (ORDER BY md5(concat(src_key, '#42')), src_key) AS r FROM c
      WHERE label = 1 AND duration IS NOT NULL AND balance IS NOT NULL AND age IS NOT NULL)
SELECT src_key, label, 0 AS is_synthetic, CAST(1 AS BIGINT) AS n, TRUE AS near FROM c
UNION ALL SELECT src_key, 1, 1, CAST(wanted // usable + (r <= wanted % usable)::INT AS BIGINT), TRUE FROM r, n
          WHERE wanted // usable + (r <= wanted % usable)::INT > 0""", ("leads_raw",))
def prep_smote(spark, sf):
    """Rows per lead, given and made, and whether those made lie within reach of its five nearest (as they must)."""
    df = labelled(spark, sf)
    scaled = prep.Scaler.fit(df, _COORDINATES).transform(df).select("src_key", "label", *_COORDINATES)
    out = prep.smote(scaled, _COORDINATES, "label", "src_key")
    complete = scaled.filter("label = 1").dropna(subset=list(_COORDINATES))
    near = nearest_neighbours(complete.select(F.col("src_key").alias("id"), F.array(*_COORDINATES).alias("x")), 5)
    reach = near.select(F.col("id").alias("src_key"), "x", F.element_at("neighbours", -1)["d"].alias("reach"))
    gap = F.aggregate(F.zip_with("x", F.array(*_COORDINATES), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    made = out.filter("is_synthetic = 1").join(reach, "src_key").groupBy("src_key", "label", "is_synthetic").agg(
        F.count(F.lit(1)).alias("n"), F.max(gap).alias("far"), F.first("reach").alias("reach"))
    given = out.filter("is_synthetic = 0").select("src_key", "label", "is_synthetic", F.lit(1).cast("long").alias("n"), F.lit(True).alias("near"))
    return given.unionByName(made.select("src_key", "label", "is_synthetic", "n", (F.col("far") <= F.col("reach") + 1e-9).alias("near")))
