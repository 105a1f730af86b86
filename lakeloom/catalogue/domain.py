"""Domain pipelines: medallion layers, fraud, marts, operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakeloom.catalogue.histories import H2, versions
from lakeloom.catalogue.registry import CUST, TXN, Tables, query
from lakeloom.functions.cleaning import bucket
from lakeloom.operators import history
from lakeloom.operators import quality as dq
from lakeloom.operators.ordered import row_positions, running_total, top_n
from lakeloom.plans import fraud, marts, medallion
from lakeloom.session import workspace
from lakeloom.sources import files
from lakeloom.sources import tables as table_io

RAW_SCHEMA = (
    "txn_id string, txn_date string, txn_time string, customer_id string, amount string, "
    "currency string, payment_mode string, merchant_id string, status string"
)


def raw_rows(t: Tables):
    """Transactions as a source system would print them, with defects by a fixed rule."""
    k = F.col("txn_id")
    money = F.format_number(F.floor("amount"), 0)
    return t.txn.select(
        F.when(k % 101 == 9, F.lit(None)).otherwise(k.cast("string")).alias("txn_id"),
        F.when(k % 103 == 8, "31/31/1999").otherwise(F.col("txn_date").cast("string")).alias("txn_date"),
        F.date_format("txn_ts", "HH:mm:ss").alias("txn_time"),
        F.concat(F.lit(" "), F.lower("customer_id")).alias("customer_id"),
        F.when(k % 97 == 1, "n/a").when(k % 89 == 2, F.concat(F.lit("-"), money)).otherwise(F.concat(F.lit("$"), money)).alias("amount"),
        F.lower("currency").alias("currency"),
        F.when(k % 71 == 5, "barter").otherwise(F.concat(F.lower("payment_mode"), F.lit(" "))).alias("payment_mode"),
        "merchant_id",
        F.lower("status").alias("status"),
    )


SILVER = f"""{TXN}, raw AS (SELECT *, CASE WHEN txn_id % 101 = 9 THEN NULL ELSE txn_id END AS id,
    CASE WHEN txn_id % 103 = 8 THEN NULL ELSE txn_date END AS d,
    CASE WHEN txn_id % 97 = 1 THEN NULL WHEN txn_id % 89 = 2 THEN -FLOOR(amount) ELSE FLOOR(amount) END AS amt,
    CASE WHEN txn_id % 71 = 5 THEN 'BARTER' ELSE payment_mode END AS mode FROM txn),
  judged AS (SELECT *, CASE WHEN id IS NULL THEN 'NULL_TXN_ID' WHEN amt IS NULL OR amt <= 0 THEN 'INVALID_AMOUNT' WHEN d IS NULL THEN 'INVALID_DATE'
    WHEN mode = 'BARTER' THEN 'UNKNOWN_PAYMENT_MODE' END AS reject_reason FROM raw)"""


def bronze(t: Tables):
    """The raw rows landed as CSV and read back with lineage columns."""
    landing, path = workspace(t.spark, "landing"), workspace(t.spark, "bronze")
    raw_rows(t).write.option("header", "true").csv(landing)
    read = files.read_csv(t.spark, landing, RAW_SCHEMA, multiLine="false")
    tagged = files.with_ingest_columns(read, "2001-08-01", "run-1", F.lit("2001-08-01").cast("timestamp"))
    table_io.write_parquet(tagged, path, partition_by=["_batch_date"])
    return t.spark.read.parquet(path)


@query(
    "m01_bronze_ingest",
    f"WITH {SILVER} SELECT id AS txn_id, UPPER(customer_id) AS customer_id, mode AS payment_mode, '2001-08-01' AS batch FROM raw",
)
def m01(t: Tables):
    rows = bronze(t).where(F.col("_source_file").isNotNull())
    return rows.select(
        F.col("txn_id").cast("bigint").alias("txn_id"),
        F.upper(F.trim("customer_id")).alias("customer_id"),
        F.upper(F.trim("payment_mode")).alias("payment_mode"),
        F.col("_batch_date").cast("string").alias("batch"),
    )


@query(
    "m02_silver_transform",
    f"""WITH {SILVER}, new AS (SELECT id, amt, status, merchant_id FROM judged WHERE reject_reason IS NULL),
        old AS (SELECT txn_id AS id, amount AS amt, 'OLD' AS status, merchant_id FROM txn WHERE txn_id % 6 = 0)
        SELECT COALESCE(n.id, o.id) AS txn_id, COALESCE(n.amt, o.amt) AS amount, COALESCE(n.status, o.status) AS status FROM new n FULL JOIN old o ON n.id = o.id""",
)
def m02(t: Tables):
    valid, _ = medallion.validate(medallion.typed_transactions(raw_rows(t)))
    silver = t.txn.where("txn_id % 6 = 0").withColumn("status", F.lit("OLD"))
    done = medallion.silver_upsert(silver, valid.select(*t.txn.columns), [F.desc("txn_ts")])
    return done.select("txn_id", "amount", "status")


@query("m02_quarantine", f"WITH {SILVER} SELECT id AS txn_id, reject_reason FROM judged WHERE reject_reason IS NOT NULL")
def m02b(t: Tables):
    _, bad = medallion.validate(medallion.typed_transactions(raw_rows(t)))
    return bad.select("txn_id", "reject_reason")


SETTINGS = fraud.FraudSettings(
    high_value=450_000, velocity_seconds=7 * 86_400, velocity_limit=1, mean_days=365, mean_factor=3, round_unit=1000, round_floor=100_000
)

SCORED = f"""{TXN}, rounded AS (SELECT * REPLACE (CASE WHEN txn_id % 10 = 0 THEN FLOOR(amount / 1000) * 1000 ELSE amount END AS amount) FROM txn),
  counted AS (SELECT *, COUNT(*) OVER (PARTITION BY customer_id ORDER BY CAST(epoch(txn_ts) AS BIGINT) RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS recent,
    AVG(amount) OVER (PARTITION BY customer_id ORDER BY txn_date RANGE BETWEEN INTERVAL 365 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS prior FROM rounded),
  flags AS (SELECT *, amount > 450000 AS f1, recent > 1 AS f2, COALESCE(amount > 3 * prior, FALSE) AS f3, amount % 1000 = 0 AND amount >= 100000 AS f4 FROM counted),
  points AS (SELECT *, CAST(f1 AS INT) * 30 + CAST(f2 AS INT) * 40 + CAST(f3 AS INT) * 20 + CAST(f4 AS INT) * 10 AS fraud_score FROM flags),
  scored AS (SELECT *, CASE WHEN fraud_score >= 60 THEN 'HIGH' WHEN fraud_score >= 30 THEN 'MEDIUM' WHEN fraud_score >= 10 THEN 'LOW' ELSE 'NORMAL' END AS fraud_risk_level FROM points)"""


def rounded(t: Tables):
    whole = F.floor(F.col("amount") / 1000) * 1000.0
    return t.txn.withColumn("amount", F.when(F.col("txn_id") % 10 == 0, whole).otherwise(F.col("amount")))


def scored(t: Tables):
    return fraud.score(rounded(t), SETTINGS)


@query(
    "m03_gold_daily_summary",
    f"""WITH {SCORED} SELECT CAST(txn_date AS VARCHAR) AS txn_date, payment_mode, currency, COUNT(txn_id) AS transaction_count, ROUND(SUM(amount), 2) AS total_volume,
        ROUND(AVG(amount), 4) AS avg_transaction_value, MAX(amount) AS max_transaction, COUNT(DISTINCT customer_id) AS unique_customers, COUNT(*) FILTER (WHERE fraud_risk_level = 'HIGH') AS high_risk_count,
        ROUND(SUM(CASE WHEN fraud_risk_level = 'HIGH' THEN amount ELSE 0 END), 2) AS high_risk_volume FROM scored GROUP BY ALL""",
)
def m03(t: Tables):
    out = medallion.daily_summary(scored(t))
    return out.withColumn("txn_date", F.col("txn_date").cast("string"))


@query(
    "m03_published_days",
    f"""WITH {TXN} SELECT CAST(txn_date AS VARCHAR) AS txn_date, CAST(SUM(1) AS BIGINT) AS transactions, ROUND(SUM(amount * CASE WHEN DAY(txn_date) = 5 THEN 2 ELSE 1 END), 2) AS volume,
          CASE WHEN DAY(txn_date) = 5 THEN '2024-01-03' ELSE '2024-01-02' END AS generated FROM txn WHERE txn_date BETWEEN DATE '1997-01-01' AND DATE '1997-01-31' GROUP BY txn_date""",
)
def m03b(t: Tables):
    """A month of daily reports is published, then one day again; only that day is replaced."""
    path = workspace(t.spark, "daily-gold")
    month = t.txn.where("txn_date BETWEEN DATE '1997-01-01' AND DATE '1997-01-31'").withColumn("fraud_risk_level", F.lit("NORMAL"))
    medallion.publish_days(medallion.daily_summary(month), path, F.lit("2024-01-02"))
    again = month.where("DAY(txn_date) = 5").withColumn("amount", F.col("amount") * 2)
    for _ in range(2):
        medallion.publish_days(medallion.daily_summary(again), path, F.lit("2024-01-03"))
    days = t.spark.read.parquet(path).groupBy("txn_date").agg(
        F.sum("transaction_count").alias("transactions"), F.round(F.sum("total_volume"), 2).alias("volume"), F.max(F.to_date("report_generated_at")).cast("string").alias("generated")
    )
    return days.withColumn("txn_date", F.col("txn_date").cast("string"))


@query(
    "m04_customer_profile",
    f"""WITH {SCORED} SELECT customer_id, COUNT(txn_id) AS lifetime_transactions, ROUND(SUM(amount), 2) AS lifetime_spend, TRUE AS mean_fits, CAST(MAX(txn_date) AS VARCHAR) AS last_transaction_date,
        string_agg(DISTINCT payment_mode, ',' ORDER BY payment_mode) AS preferred_modes, COUNT(*) FILTER (WHERE fraud_risk_level = 'HIGH') AS fraud_flags FROM scored GROUP BY customer_id""",
)
def m04(t: Tables):
    out = medallion.customer_profile(scored(t))
    # Four decimals of a mean may be a tie, which sums in another order break; hence a bound.
    off = F.abs(F.col("avg_transaction_value") - F.col("lifetime_spend") / F.col("lifetime_transactions"))
    return out.withColumn("mean_fits", off < 0.006).drop("avg_transaction_value").withColumns(
        {"last_transaction_date": F.col("last_transaction_date").cast("string"), "preferred_modes": F.array_join("preferred_modes", ",")}
    )


@query("m05_fraud_high_value", f"WITH {SCORED} SELECT txn_id, f1 AS flag_high_value FROM scored")
def m05(t: Tables):
    return scored(t).select("txn_id", "flag_high_value")


@query("m06_fraud_velocity", f"WITH {SCORED} SELECT txn_id, recent AS txn_count_recent, f2 AS flag_high_velocity FROM scored")
def m06(t: Tables):
    return scored(t).select("txn_id", "txn_count_recent", "flag_high_velocity")


@query("m07_fraud_amount_anomaly", f"WITH {SCORED} SELECT txn_id, ROUND(prior, 6) AS avg_prior, f3 AS flag_amount_anomaly FROM scored")
def m07(t: Tables):
    return scored(t).select("txn_id", F.round("avg_prior", 6).alias("avg_prior"), "flag_amount_anomaly")


@query("m08_fraud_round_amount", f"WITH {SCORED} SELECT txn_id, f4 AS flag_round_amount FROM scored")
def m08(t: Tables):
    return scored(t).select("txn_id", "flag_round_amount")


@query("m09_fraud_score", f"WITH {SCORED} SELECT txn_id, fraud_score, fraud_risk_level FROM scored")
def m09(t: Tables):
    return scored(t).select("txn_id", "fraud_score", "fraud_risk_level")


@query(
    "m10_velocity_offenders",
    """SELECT user_id, MAX(n) AS most_in_a_day FROM (SELECT user_id, COUNT(*) OVER (PARTITION BY user_id ORDER BY CAST(floor(epoch(ts)) AS BIGINT) RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS n FROM events)
       WHERE n > 5 GROUP BY user_id""",
)
def m10(t: Tables):
    at = t.events.select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    recent = fraud.recent_count(at, "user_id", "ts", 86_400, "n").where("n > 5")
    return recent.groupBy("user_id").agg(F.max("n").alias("most_in_a_day"))


SEGMENT_CASE = """CASE WHEN s >= 2000000 AND n >= 10 THEN 'CHAMPION' WHEN s >= 800000 AND n >= 5 THEN 'LOYAL' WHEN s >= 200000 THEN 'POTENTIAL' WHEN s > 0 THEN 'AT_RISK' ELSE 'INACTIVE' END"""
SEGMENT_SQL = f"""SELECT {SEGMENT_CASE} AS segment, city, COUNT(*) AS customer_count, ROUND(AVG(s), 6) AS avg_spend, ROUND(AVG(n), 6) AS avg_txn_count FROM a LEFT JOIN cust USING (customer_id) GROUP BY 1, 2"""


def _segments(t: Tables, activity):
    labelled = activity.withColumn("segment", marts.segment(F.col("recent_spend"), F.col("recent_txns"), 40.0))
    return labelled.join(t.customers.select("customer_id", "city"), "customer_id", "left").groupBy("segment", "city").agg(
        F.count(F.lit(1)).alias("customer_count"), F.round(F.avg("recent_spend"), 6).alias("avg_spend"), F.round(F.avg("recent_txns"), 6).alias("avg_txn_count")
    )


@query(
    "m11_segments_last_30_rows",
    f"""WITH {TXN}, {CUST}, a AS (SELECT customer_id, SUM(amount) AS s, COUNT(*) AS n FROM (SELECT * FROM txn QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY txn_date DESC, txn_id DESC) <= 30) GROUP BY 1) {SEGMENT_SQL}""",
)
def m11(t: Tables):
    return _segments(t, marts.recent_activity_rows(t.txn, 30))


@query(
    "m11_segments_last_365_days",
    f"""WITH {TXN}, {CUST}, l AS (SELECT customer_id, MAX(txn_date) AS last FROM txn GROUP BY 1), a AS (SELECT customer_id, SUM(amount) AS s, COUNT(*) AS n FROM txn JOIN l USING (customer_id) WHERE txn_date > last - 365 GROUP BY 1) {SEGMENT_SQL}""",
)
def m11b(t: Tables):
    return _segments(t, marts.recent_activity_days(t.txn, 365))


@query(
    "m12_lifetime_running_value",
    f"""WITH {TXN} SELECT txn_id, ROUND(SUM(amount) OVER (PARTITION BY customer_id ORDER BY txn_date, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_total FROM txn""",
)
def m12(t: Tables):
    out = running_total(t.txn, ["customer_id"], [F.col("txn_date"), F.col("txn_id")], "amount", block=F.trunc("txn_date", "year"))
    return out.select("txn_id", F.round("running_total", 2).alias("running_total"))


@query(
    "m13_executive_dashboard",
    f"""WITH {SCORED}, {CUST}, d AS (SELECT txn_date, payment_mode, city, tier, COUNT(*) AS transactions, SUM(amount) AS revenue, COUNT(DISTINCT customer_id) AS unique_customers,
          COUNT(*) FILTER (WHERE fraud_risk_level = 'HIGH') AS fraud_alerts FROM scored LEFT JOIN cust USING (customer_id) GROUP BY ALL)
        SELECT CAST(txn_date AS VARCHAR) AS txn_date, CAST(YEAR(txn_date) AS INT) AS year, CAST(MONTH(txn_date) AS INT) AS month, strftime(txn_date, '%B') AS month_name, CAST(QUARTER(txn_date) AS INT) AS quarter,
          payment_mode, city, tier, transactions, TRUE AS mean_fits, ROUND(revenue, 2) AS revenue, unique_customers, fraud_alerts, ROUND(fraud_alerts * 100.0 / NULLIF(transactions, 0), 2) AS fraud_rate_pct,
          ROUND(LAG(revenue) OVER (PARTITION BY payment_mode, city, tier ORDER BY txn_date), 2) AS previous_revenue,
          ROUND(SUM(revenue) OVER (PARTITION BY payment_mode, city, tier, YEAR(txn_date), MONTH(txn_date)), 2) AS monthly_revenue FROM d""",
)
def m13(t: Tables):
    out = marts.executive_dashboard(scored(t), t.customers)
    off = F.abs(F.col("avg_transaction_value") - F.col("revenue") / F.col("transactions"))
    out = out.withColumn("mean_fits", off < 0.011).drop("avg_transaction_value")
    return out.withColumn("txn_date", F.col("txn_date").cast("string"))


@query(
    "m14_fan_out_marts",
    f"""WITH {SCORED} SELECT 'sales' AS mart, COUNT(DISTINCT (txn_date, merchant_id)) AS n, ROUND(SUM(amount), 2) AS total FROM scored WHERE payment_mode IN ('CARD', 'UPI')
        UNION ALL SELECT 'fraud', COUNT(*), ROUND(SUM(amount), 2) FROM scored WHERE fraud_risk_level <> 'NORMAL'
        UNION ALL SELECT 'finance', COUNT(DISTINCT (txn_date, currency)), ROUND(SUM(amount), 2) FROM scored WHERE status = 'COMPLETED'""",
)
def m14(t: Tables):
    path = workspace(t.spark, "marts")
    targets = {"sales": (marts.sales_mart, "total_sales"), "fraud": (marts.fraud_mart, "amount"), "finance": (marts.finance_mart, "settled_amount")}
    marts.fan_out(scored(t), {n: (build, f"{path}/{n}") for n, (build, _) in targets.items()})
    out = None
    for name, (_, amount) in targets.items():
        one = t.spark.read.parquet(f"{path}/{name}").agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("n"), F.round(F.sum(amount), 2).alias("total"))
        out = one if out is None else out.unionByName(one)
    return out


ENTITIES = {
    "orders": marts.Entity(("txn_id",), "txn_date", (dq.accepted_range("amount", low=0), dq.not_null("customer_id"))),
    "parts": marts.Entity(("p_partkey",), "p_size", (dq.not_null("p_name"),)),
}


@query(
    "m15_config_driven_entities",
    """SELECT 'orders' AS entity, CAST(COUNT(*) AS BIGINT) AS target_rows, COUNT(*) FILTER (WHERE o_orderdate >= DATE '2000-01-01' AND NOT (o_orderkey % 97 = 1 OR o_orderkey % 89 = 2 OR o_orderkey % 83 = 3)) AS records_read,
         (SELECT COUNT(*) FROM orders WHERE o_orderkey % 97 = 1 OR o_orderkey % 89 = 2 OR o_orderkey % 83 = 3) AS rejected
       FROM orders WHERE o_orderdate < DATE '2000-01-01' OR NOT (o_orderkey % 97 = 1 OR o_orderkey % 89 = 2 OR o_orderkey % 83 = 3)
       UNION ALL SELECT 'parts', COUNT(*), COUNT(*), 0 FROM part""",
)
def m15(t: Tables):
    runs = {
        "orders": (t.dirty, t.dirty.where(F.col("txn_date") < "2000-01-01"), dt.date(2000, 1, 1)),
        "parts": (t.part, t.part.limit(0), None),
    }
    out = None
    for name, (source, target, watermark) in runs.items():
        done, load = marts.run_entity(name, ENTITIES[name], source, target, watermark)
        line = load.target.agg(
            F.lit(name).alias("entity"),
            F.count(F.lit(1)).alias("target_rows"),
            F.first(load.stats.select("records_read").scalar()).alias("records_read"),
            F.first(done.failed.agg(F.count(F.lit(1))).scalar()).alias("rejected"),
        )
        out = line if out is None else out.unionByName(line)
    return out


def run_log(t: Tables):
    """A run log read out of the events: value as minutes, errors as failed runs."""
    status = F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS")
    return t.events.select(
        F.to_date("ts").cast("string").alias("batch_date"), F.round(F.col("value") * 60, 2).alias("total_duration"), status.alias("status"), "event_id"
    )


RUN_LOG = "log AS (SELECT CAST(ts::DATE AS VARCHAR) AS batch_date, ROUND(value * 60, 2) AS total_duration, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status, event_id FROM events)"


@query(
    "m16_run_log_trend",
    f"""WITH {RUN_LOG} SELECT batch_date, ROUND(AVG(total_duration), 4) AS avg_duration_seconds, MAX(total_duration) AS max_duration_seconds, COUNT(*) AS run_count,
        COUNT(*) FILTER (WHERE status = 'SUCCESS') AS success_count, COUNT(*) FILTER (WHERE status = 'FAILED') AS failure_count,
        ROUND(COUNT(*) FILTER (WHERE status = 'SUCCESS') / COUNT(*) * 100, 4) AS success_rate_pct FROM log GROUP BY batch_date""",
)
def m16(t: Tables):
    return marts.run_trend(run_log(t))


@query("m16_sla_breaches", f"WITH {RUN_LOG} SELECT event_id, batch_date, total_duration, status FROM log WHERE total_duration > 7200")
def m16b(t: Tables):
    return marts.sla_breaches(run_log(t)).select("event_id", "batch_date", "total_duration", "status")


@query(
    "m17_usage_cost",
    """SELECT event_type AS run_name, CAST(ts::DATE AS VARCHAR) AS run_date, ROUND(SUM(value), 4) AS units, ROUND(SUM(value * 0.4), 4) AS estimated_cost, ROUND(AVG(CAST(user_id AS DOUBLE)), 4) AS avg_runtime_min FROM events GROUP BY 1, 2""",
)
def m17(t: Tables):
    usage = t.events.select(F.col("event_id").alias("run_id"), F.col("value").alias("usage_quantity"))
    runs = t.events.select(
        F.col("event_id").alias("run_id"), F.col("event_type").alias("run_name"), F.to_date("ts").cast("string").alias("run_date"), F.col("user_id").cast("double").alias("runtime_minutes")
    )
    return marts.usage_cost(usage, runs)


@query(
    "m18_price_history",
    f"""WITH {H2} SELECT p_partkey, CAST(ROW_NUMBER() OVER (PARTITION BY p_partkey ORDER BY valid_from) AS INT) AS version, price FROM h""",
)
def m18(t: Tables):
    """Prices of each product in order of validity, with the time before a price was known."""
    placed = row_positions(versions(t), ["p_partkey"], [F.col("valid_from")], F.trunc("valid_from", "year"), "version")
    return placed.select("p_partkey", F.col("version").cast("int").alias("version"), "price")


@query(
    "m19_group_summary",
    f"""WITH {CUST} SELECT tier, COUNT(*) AS headcount, ROUND(AVG(balance), 4) AS avg_salary, MAX(balance) AS max_salary, COUNT(*) FILTER (WHERE balance < 0) AS no_bonus FROM cust GROUP BY tier""",
)
def m19(t: Tables):
    bonus = t.customers.withColumn("bonus", bucket(F.col("balance"), (0, 5000), ("NONE", "SMALL", "LARGE")))
    none = bonus.groupBy("tier").agg(F.count(F.when(F.col("bonus") == "NONE", F.lit(1))).alias("no_bonus"))
    return marts.group_summary(t.customers, "tier", "balance").join(none, "tier")


SENSOR = """sensor AS (SELECT event_id, 'D' || (user_id % 40) AS device_id, 'V' || (user_id % 20) AS vehicle_id, ts, value AS speed_kmh, value / 4 AS temperature_c, 100 - value AS fuel_level_pct,
  CAST(user_id % 90 AS DOUBLE) AS latitude, CAST(user_id % 180 AS DOUBLE) AS longitude, CASE WHEN event_type = 'error' THEN 'FAULT' ELSE 'RUNNING' END AS engine_status FROM events)"""


def sensors(events):
    """Events as vehicle readings; works on a table and on a stream."""
    user = F.col("user_id")
    return events.select(
        "event_id",
        F.concat(F.lit("D"), (user % 40).cast("string")).alias("device_id"),
        F.concat(F.lit("V"), (user % 20).cast("string")).alias("vehicle_id"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.col("value").alias("speed_kmh"),
        (F.col("value") / 4).alias("temperature_c"),
        (100 - F.col("value")).alias("fuel_level_pct"),
        F.when(F.col("event_type") == "error", "FAULT").otherwise("RUNNING").alias("engine_status"),
        (user % 90).cast("double").alias("latitude"),
        (user % 180).cast("double").alias("longitude"),
    )


@query(
    "m20_sensor_alerts",
    f"""WITH {SENSOR} SELECT event_id, CASE WHEN speed_kmh > 120 OR engine_status <> 'RUNNING' THEN 'CRITICAL' WHEN temperature_c > 45 OR fuel_level_pct < 10 THEN 'WARNING' ELSE 'NORMAL' END AS alert_level FROM sensor""",
)
def m20(t: Tables):
    return marts.sensor_alerts(sensors(t.events)).select("event_id", "alert_level")
