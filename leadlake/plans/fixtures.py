"""Domain views over the given tables: one SQL text each, readable by Spark and by any ANSI engine.

``default`` is a reserved word, so the texts call the column ``in_default``; the frames rename it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEADS_RAW = """
SELECT concat('CUST_', lpad(CAST(c.c_custkey AS STRING), 6, '0')) AS customer_id,
       CASE WHEN c.c_custkey % 100 = 0 THEN '12345'
            ELSE concat('09', lpad(CAST(c.c_custkey AS STRING), 8, '0')) END AS phone,
       CAST(12 + c.c_custkey % 97 AS INT) AS age,
       CASE c.c_custkey % 12 WHEN 0 THEN ' Admin. ' WHEN 1 THEN 'blue-collar'
            WHEN 2 THEN 'entrepreneur' WHEN 3 THEN 'housemaid' WHEN 4 THEN 'Management'
            WHEN 5 THEN 'retired' WHEN 6 THEN 'self-employed' WHEN 7 THEN 'services'
            WHEN 8 THEN 'student' WHEN 9 THEN 'technician' WHEN 10 THEN 'unemployed'
            ELSE 'unknown' END AS job,
       CASE c.c_custkey % 3 WHEN 0 THEN 'married' WHEN 1 THEN 'single' ELSE 'divorced' END AS marital,
       CASE c.c_nationkey % 4 WHEN 0 THEN 'primary' WHEN 1 THEN 'secondary'
            WHEN 2 THEN 'tertiary' ELSE 'unknown' END AS education,
       CASE WHEN c.c_custkey % 50 = 0 THEN 'yes' ELSE 'no' END AS in_default,
       c.c_acctbal + CAST(o.o_orderkey % 5 AS DOUBLE) * 250.0E0 AS balance,
       CASE WHEN c.c_nationkey % 2 = 0 THEN 'yes' ELSE 'no' END AS housing,
       CASE WHEN c.c_custkey % 6 = 1 THEN 'yes' ELSE 'no' END AS loan,
       CASE o.o_orderkey % 3 WHEN 0 THEN 'cellular' WHEN 1 THEN 'telephone' ELSE 'unknown' END AS contact,
       CAST(extract(DAY FROM o.o_orderdate) AS INT) AS day,
       CASE CAST(extract(MONTH FROM o.o_orderdate) AS INT)
            WHEN 1 THEN 'jan' WHEN 2 THEN 'feb' WHEN 3 THEN 'mar' WHEN 4 THEN 'apr'
            WHEN 5 THEN 'may' WHEN 6 THEN 'jun' WHEN 7 THEN 'jul' WHEN 8 THEN 'aug'
            WHEN 9 THEN 'sep' WHEN 10 THEN 'oct' WHEN 11 THEN 'nov' ELSE 'dec' END AS month,
       CASE WHEN o.o_orderkey % 211 = 0 THEN NULL
            ELSE CAST(o.o_orderkey * 7919 % 1811 AS DOUBLE) - 10.0E0 END AS duration,
       CAST(o.o_orderkey % 7 AS INT) AS campaign,
       CAST(CASE WHEN o.o_orderkey % 5 = 0 THEN 1 + o.o_orderkey % 400 ELSE -1 END AS INT) AS pdays,
       CAST(CASE WHEN o.o_orderkey % 5 = 0 THEN 1 + o.o_orderkey % 6 ELSE 0 END AS INT) AS previous,
       CASE WHEN o.o_orderkey % 5 <> 0 THEN 'unknown' WHEN o.o_orderkey % 15 = 0 THEN 'success'
            WHEN o.o_orderkey % 10 = 0 THEN 'failure' ELSE 'other' END AS poutcome,
       CASE WHEN o.o_orderstatus = 'F' AND o.o_orderkey * 7919 % 1811 > 900 THEN 'yes' ELSE 'no' END AS y,
       o.o_orderkey AS src_key,
       o.o_orderdate AS event_ts
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
"""

# Every lead that was contacted before is delivered a second time, a day later, with changed values.
LEADS_DUP = """
SELECT * FROM {leads_raw}
UNION ALL
SELECT customer_id, phone, age, job, marital, education, in_default, balance + 1000.0E0, housing, loan,
       contact, day, month, duration, campaign, pdays, previous + 1, poutcome, y, src_key,
       event_ts + INTERVAL 1 DAY
FROM {leads_raw} WHERE pdays > -1
"""

SCORED = """
SELECT src_key, customer_id, age, marital, CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS label,
       CAST((src_key * 104729) % 7001 + CASE WHEN y = 'yes' THEN 2500 ELSE 0 END AS DOUBLE) / 10000.0E0 AS score
FROM {leads_raw}
"""

CALL_FEEDBACK = """
SELECT concat('FB_', CAST(event_id AS STRING)) AS feedback_id,
       concat('CUST_', lpad(CAST(user_id AS STRING), 6, '0')) AS customer_id,
       concat('AGENT_', lpad(CAST(user_id % 50 AS STRING), 3, '0')) AS agent_id,
       CAST(floor(value) AS INT) AS call_duration,
       CASE event_type WHEN 'purchase' THEN 'agreed' WHEN 'click' THEN 'callback'
            WHEN 'view' THEN 'declined' WHEN 'error' THEN 'unreachable' ELSE event_type END AS outcome,
       ts AS recorded_at
FROM {events}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a file stream. The pattern lets it be one file or a folder of files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def leads_from(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Leads of an orders frame, which may be a stream."""
    spark = orders.sparkSession
    return spark.sql(LEADS_RAW, orders=orders, customer=customer).withColumnRenamed("in_default", "default")


def leads_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads_from(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


def leads_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = leads_raw(spark, sf_dir).withColumnRenamed("default", "in_default")
    return spark.sql(LEADS_DUP, leads_raw=raw).withColumnRenamed("in_default", "default")


def scored_from(leads: DataFrame) -> DataFrame:
    return leads.sparkSession.sql(SCORED, leads_raw=leads)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_from(leads_raw(spark, sf_dir))


def feedback_from(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(CALL_FEEDBACK, events=events).withColumn(
        "recorded_at", F.col("recorded_at").cast("timestamp")
    )


def call_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feedback_from(table(spark, sf_dir, "events"))


def oracle_views() -> dict[str, str]:
    """The same views as named sub-queries for an oracle text."""
    return {
        "leads_raw": LEADS_RAW.format(orders="orders", customer="customer"),
        "leads_dup": LEADS_DUP.format(leads_raw="leads_raw"),
        "scored": SCORED.format(leads_raw="leads_raw"),
        "call_feedback": CALL_FEEDBACK.format(events="events"),
    }
