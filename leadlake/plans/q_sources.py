"""Registered queries: scans, sinks, catalog."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadlake.plans import fixtures as fx
from leadlake.plans.catalogue import query, tidy
from leadlake.schemas import LEADS
from leadlake.session import shared_dir
from leadlake.sources import catalog, readers, sinks

_COLUMNS = [f.name for f in LEADS]
_SQL_COLUMNS = ", ".join("in_default" if c == "default" else f"round({c}, 6) AS {c}" if c in ("balance", "duration")
                         else c for c in _COLUMNS)
_ALL_LEADS = f"SELECT {_SQL_COLUMNS} FROM leads_raw"


def _leads(spark, sf):
    return fx.leads_raw(spark, sf).select(*_COLUMNS)


@query("src_csv_scan", _ALL_LEADS, ("leads_raw",))
def src_csv_scan(spark, sf):
    """The file has its columns in another order, one that the schema does not know, and lacks one (the phone)."""
    path = shared_dir(spark, "csv")
    leads = _leads(spark, sf)
    sinks.write_csv(leads.withColumn("branch", F.lit("north")).select("branch", *sorted(set(_COLUMNS) - {"phone"})), path)
    found = readers.read_csv(spark, path, LEADS)
    phones = leads.select("src_key", "phone")
    return tidy(found.drop("branch").join(phones, "src_key").select(*_COLUMNS))


@query("src_parquet_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice FROM orders")
def src_parquet_scan(spark, sf):
    df = readers.read_parquet(spark, f"{sf}/orders.parquet")
    return tidy(df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"))


@query("src_folder_scan", """
SELECT batch, CAST(count(*) AS BIGINT) AS n, CAST(count(y) AS BIGINT) AS n_labelled, round(sum(balance), 2) AS balance FROM (
  SELECT 'first' AS batch, CAST(NULL AS VARCHAR) AS y, balance FROM leads_raw
  UNION ALL SELECT 'second' AS batch, y, balance FROM leads_dup
) GROUP BY batch""", ("leads_dup",))
def src_folder_scan(spark, sf):
    path = shared_dir(spark, "folder")
    sinks.append_batch(_leads(spark, sf).drop("y"), path, "first")
    sinks.append_batch(fx.leads_dup(spark, sf).select(*_COLUMNS), path, "second")
    rows = readers.read_folder(spark, path)
    return tidy(rows.groupBy(F.col("_batch_id").alias("batch")).agg(
        F.count(F.lit(1)).alias("n"), F.count("y").alias("n_labelled"), F.sum("balance").alias("balance")), 2)


@query("src_arff_scan", """
SELECT CAST(src_key AS DOUBLE) AS src_key, CAST(age AS DOUBLE) AS age, trim(job) AS job, round(balance, 6) AS balance,
       round(duration, 6) AS duration, y FROM leads_raw""", ("leads_raw",))
def src_arff_scan(spark, sf):
    path, head = shared_dir(spark, "arff"), shared_dir(spark, "arff-head")
    lines = [
        "% leads", "@RELATION leads", "", "@ATTRIBUTE src_key NUMERIC", "@ATTRIBUTE age NUMERIC", "@ATTRIBUTE job STRING",
        "@ATTRIBUTE balance REAL", "@ATTRIBUTE duration REAL", "@ATTRIBUTE y {no,yes}", "", "@DATA",
    ]
    spark.createDataFrame([("\n".join(lines),)], "value string").write.text(head)
    quoted = F.concat(F.lit("'"), F.col("job"), F.lit("'"))
    cells = [F.col("src_key"), F.col("age"), quoted, F.col("balance"), F.col("duration"), F.col("y")]
    text = F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("?")) for c in cells])
    _leads(spark, sf).select(text.alias("value")).write.text(path)
    return tidy(readers.read_arff(spark, path, header_path=head).withColumn("job", F.trim("job")))


@query("src_json_leads", _ALL_LEADS, ("leads_raw",))
def src_json_leads(spark, sf):
    path = shared_dir(spark, "json")
    _leads(spark, sf).write.json(path)
    return tidy(readers.read_json_leads(spark, path, LEADS))


@query("src_json_payloads", _ALL_LEADS, ("leads_raw",))
def src_json_payloads(spark, sf):
    payloads = _leads(spark, sf).select(F.to_json(F.struct(*_COLUMNS)).alias("payload"))
    return tidy(readers.parse_json_leads(payloads, "payload", LEADS))


@query("snk_bronze_append", """
SELECT 'b1' AS batch, src_key, round(balance, 6) AS balance FROM leads_raw
UNION ALL SELECT 'b2' AS batch, src_key, round(balance, 6) AS balance FROM leads_dup""", ("leads_dup",))
def snk_bronze_append(spark, sf):
    path = shared_dir(spark, "bronze")
    # A batch that comes again, smaller or empty, leaves nothing of its first delivery.
    sinks.append_batch(fx.leads_dup(spark, sf).select(*_COLUMNS), path, "b1")
    sinks.append_batch(_leads(spark, sf), path, "b1")
    sinks.append_batch(_leads(spark, sf), path, "b3")
    sinks.append_batch(_leads(spark, sf).filter("false"), path, "b3")
    for _ in range(2):
        sinks.append_batch(fx.leads_dup(spark, sf).select(*_COLUMNS), path, "b2")
    return tidy(spark.read.parquet(path).select(F.col("_batch_id").alias("batch"), "src_key", "balance"))


@query("snk_table_overwrite", _ALL_LEADS, ("leads_raw",))
def snk_table_overwrite(spark, sf):
    path = shared_dir(spark, "table")
    sinks.overwrite_table(fx.leads_dup(spark, sf).select(*_COLUMNS), path)
    sinks.overwrite_table(_leads(spark, sf), path)
    return tidy(spark.read.parquet(path))


@query("snk_csv", "SELECT src_key, job, month, round(balance, 6) AS balance FROM leads_raw", ("leads_raw",))
def snk_csv(spark, sf):
    path = shared_dir(spark, "out-csv")
    sinks.write_csv(_leads(spark, sf).select("src_key", "job", "month", "balance"), path)
    return tidy(readers.read_csv(spark, path, StructType([LEADS[c] for c in ("src_key", "job", "month", "balance")])))


@query("snk_sql_export", """
SELECT contact, poutcome, CAST(count(*) AS BIGINT) AS n, round(avg(balance), 4) AS avg_balance
FROM leads_raw GROUP BY contact, poutcome""", ("leads_raw",))
def snk_sql_export(spark, sf):
    path = shared_dir(spark, "export")
    text = "SELECT contact, poutcome, count(*) AS n, avg(balance) AS avg_balance FROM {leads} GROUP BY contact, poutcome"
    sinks.export_query(spark, text, path, leads=_leads(spark, sf))
    return tidy(spark.read.parquet(path), 4)


@query("cat_register_parquet", "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer")
def cat_register_parquet(spark, sf):
    catalog.register_parquet(spark, "leadlake_customer", f"{sf}/customer.parquet")
    return catalog.run_sql(spark, "SELECT c_custkey, c_mktsegment, c_nationkey FROM leadlake_customer")


@query("cat_register_df", "SELECT month, CAST(count(*) AS BIGINT) AS n FROM leads_raw GROUP BY month", ("leads_raw",))
def cat_register_df(spark, sf):
    catalog.register_frame(_leads(spark, sf), "leadlake_leads")
    return catalog.run_sql(spark, "SELECT month, count(*) AS n FROM leadlake_leads GROUP BY month")


@query("sql_param_query", """
SELECT o_orderkey, o_orderpriority, round(o_totalprice, 6) AS o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice >= 250000""")
def sql_param_query(spark, sf):
    catalog.register_parquet(spark, "leadlake_orders", f"{sf}/orders.parquet")
    text = ("SELECT o_orderkey, o_orderpriority, o_totalprice FROM leadlake_orders "
            "WHERE o_orderstatus = :status AND o_totalprice >= :floor")
    return tidy(catalog.run_sql(spark, text, {"status": "F", "floor": 250000.0}))
