"""Slowly changing dimensions and incremental loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakeloom.catalogue.registry import TXN, Tables, query
from lakeloom.operators import history, incremental, sequences


def moment(text: str):
    return F.lit(text).cast("timestamp")


def products(t: Tables):
    return t.part.select("p_partkey", "p_name", F.col("p_retailprice").alias("price"))


def repriced(t: Tables):
    """Every seventh product 10 % dearer, every eleventh without a price, and new ones."""
    k = F.col("p_partkey")
    price = F.when(k % 7 == 0, F.round(F.col("price") * 1.1, 2)).when(k % 11 == 0, F.lit(None)).otherwise(F.col("price"))
    known = products(t).withColumn("price", price)
    new = products(t).where(k % 40 == 1).withColumn("p_partkey", k + 1_000_000_000)
    return known.unionByName(new)


REPRICED = """p AS (SELECT p_partkey, p_name, p_retailprice AS price FROM part), r AS (
  SELECT p_partkey, p_name, CASE WHEN p_partkey % 7 = 0 THEN ROUND(price * 1.1, 2) WHEN p_partkey % 11 = 0 THEN NULL ELSE price END AS price FROM p
  UNION ALL SELECT p_partkey + 1000000000, p_name, price FROM p WHERE p_partkey % 40 = 1)"""

H2 = f"""{REPRICED}, h AS (
  SELECT p.p_partkey, p.p_name, p.price, '2024-01-01' AS valid_from,
    CASE WHEN p.price IS DISTINCT FROM r.price THEN '2024-02-01' END AS valid_to, p.price IS NOT DISTINCT FROM r.price AS is_current
  FROM p JOIN r USING (p_partkey)
  UNION ALL SELECT r.p_partkey, r.p_name, r.price, '2024-02-01', NULL, TRUE FROM r LEFT JOIN p USING (p_partkey)
  WHERE p.p_partkey IS NULL OR p.price IS DISTINCT FROM r.price)"""


def versions(t: Tables, **how):
    first = history.open_history(products(t), moment("2024-01-01"))
    source = repriced(t).withColumn("changed_at", moment("2024-02-01"))
    return history.scd2(first, source, "p_partkey", ["price"], "changed_at", **how)


REOPENED = """WITH first AS (SELECT p_partkey, p_retailprice AS price, '2024-01-01' AS valid_from, CASE WHEN p_partkey % 5 = 0 THEN '2024-01-05' END AS valid_to FROM part)
  SELECT *, valid_to IS NULL AS is_current FROM first
  UNION ALL SELECT p_partkey, p_retailprice, '2024-02-01', NULL, TRUE FROM part WHERE p_partkey % 5 = 0"""


def _reopened(t: Tables, block=None):
    """Every fifth product was closed; all come again with the price they had."""
    prices = t.part.select("p_partkey", F.col("p_retailprice").alias("price"))
    first = history.open_history(prices, moment("2024-01-01"))
    closed = F.col("p_partkey") % 5 == 0
    first = first.withColumn("valid_to", F.when(closed, moment("2024-01-05"))).withColumn("is_current", ~closed)
    again = prices.withColumn("changed_at", moment("2024-02-01"))
    return dated(history.scd2(first, again, "p_partkey", ["price"], "changed_at", block=block))


@query("h02_scd2_reopened_key", REOPENED)
def h02_reopened(t: Tables):
    return _reopened(t)


@query("h02_scd2_reopened_key_blocked", REOPENED)
def h02_reopened_blocked(t: Tables):
    return _reopened(t, F.trunc("valid_from", "month"))


def dated(df):
    return df.withColumns({c: F.col(c).cast("date").cast("string") for c in ("valid_from", "valid_to") if c in df.columns})


@query(
    "h01_scd1_overwrite",
    f"""WITH {REPRICED} SELECT COALESCE(p.p_partkey, r.p_partkey) AS p_partkey, COALESCE(p.p_name, r.p_name) AS p_name, r.price FROM p FULL JOIN r USING (p_partkey)""",
)
def h01(t: Tables):
    return history.scd1(products(t), repriced(t), ["p_partkey"], ["price"])


@query("h02_scd2_history", f"WITH {H2} SELECT * FROM h")
def h02(t: Tables):
    return dated(versions(t))


@query("h02_scd2_blocked_rerun", f"WITH {H2} SELECT * FROM h")
def h02b(t: Tables):
    """Running the same batch again changes nothing, here with time blocks for huge keys."""
    source = repriced(t).withColumn("changed_at", moment("2024-02-01"))
    block = F.trunc("valid_from", "month")
    return dated(history.scd2(versions(t), source, "p_partkey", ["price"], "changed_at", block))


@query(
    "h02_scd2_several_versions_per_batch",
    """WITH e AS (SELECT DISTINCT user_id, date_trunc('day', ts) AS d FROM events),
       s AS (SELECT user_id, d, CAST(dayofyear(d) // 3 AS INT) AS state FROM e),
       c AS (SELECT *, LAG(state) OVER (PARTITION BY user_id ORDER BY d) AS before FROM s),
       k AS (SELECT user_id, state, d FROM c WHERE state IS DISTINCT FROM before)
       SELECT user_id, state, CAST(d::DATE AS VARCHAR) AS valid_from, CAST((LEAD(d) OVER w)::DATE AS VARCHAR) AS valid_to, LEAD(d) OVER w IS NULL AS is_current
       FROM k WINDOW w AS (PARTITION BY user_id ORDER BY d)""",
)
def h02c(t: Tables):
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    source = t.events.select("user_id", (F.dayofyear("ts") / 3).cast("int").alias("state"), day.alias("at"))
    empty = history.open_history(source.limit(0).drop("at"), moment("2024-01-01"))
    return dated(history.scd2(empty, source, "user_id", ["state"], "at", F.trunc("valid_from", "month")))


@query(
    "h03_scd3_previous_value",
    f"""WITH {REPRICED} SELECT COALESCE(p.p_partkey, r.p_partkey) AS p_partkey, COALESCE(r.p_name, p.p_name) AS p_name, r.price,
        CASE WHEN p.p_partkey IS NOT NULL AND p.price IS DISTINCT FROM r.price THEN p.price END AS prev_price FROM p FULL JOIN r USING (p_partkey)""",
)
def h03(t: Tables):
    return history.scd3(products(t), repriced(t), ["p_partkey"], "price")


@query("h04_scd4_current_and_history", f"WITH {H2} SELECT CASE WHEN is_current THEN 'current' ELSE 'history' END AS part, COUNT(*) AS n, ROUND(SUM(price), 2) AS total FROM h GROUP BY 1")
def h04(t: Tables):
    first = history.open_history(products(t), moment("2024-01-01"))
    source = repriced(t).withColumn("changed_at", moment("2024-02-01"))
    current, closed = history.scd4(first, source, "p_partkey", ["price"], "changed_at")

    def size(df, part):
        return df.agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("total"))

    return size(current, "current").unionByName(size(closed, "history"))


@query("h05_current_view", f"WITH {H2} SELECT p_partkey, p_name, price FROM h WHERE is_current")
def h05(t: Tables):
    return history.current_rows(versions(t))


@query("h06_state_as_of", "SELECT p_partkey, p_retailprice AS price FROM part")
def h06(t: Tables):
    return history.state_as_of(versions(t), F.lit("2024-01-15")).select("p_partkey", "price")


CUT = "1999-01-01"
LOAD_SQL = f"""{TXN}, base AS (SELECT txn_id, amount, txn_date FROM txn WHERE txn_date < DATE '{CUT}' AND txn_id % 5 <> 0),
  fresh AS (SELECT txn_id, amount + 1 AS amount, txn_date FROM txn WHERE txn_date >= DATE '{CUT}'
    UNION ALL SELECT txn_id, amount + 2, txn_date + 1 FROM txn WHERE txn_date >= DATE '{CUT}' AND txn_id % 3 = 0),
  latest AS (SELECT * FROM fresh QUALIFY ROW_NUMBER() OVER (PARTITION BY txn_id ORDER BY txn_date DESC) = 1)"""


def load(t: Tables):
    day = F.col("txn_date")
    rows = t.txn.select("txn_id", "amount", "txn_date")
    base = rows.where((day < CUT) & (F.col("txn_id") % 5 != 0))
    again = rows.where("txn_id % 3 = 0").select("txn_id", (F.col("amount") + 2).alias("amount"), F.date_add("txn_date", 1).alias("txn_date"))
    source = rows.withColumn("amount", F.col("amount") + 1).unionByName(again.where(day > CUT))
    return incremental.incremental_load(source, base, ["txn_id"], "txn_date", dt.date(1999, 1, 1))


@query(
    "h07_incremental_load",
    f"""WITH {LOAD_SQL} SELECT txn_id, amount, CAST(txn_date AS VARCHAR) AS txn_date FROM base
        WHERE txn_id NOT IN (SELECT txn_id FROM latest) UNION ALL SELECT txn_id, amount, CAST(txn_date AS VARCHAR) FROM latest""",
)
def h07(t: Tables):
    return load(t).target.withColumn("txn_date", F.col("txn_date").cast("string"))


@query(
    "h07_incremental_load_stats",
    f"""WITH {LOAD_SQL} SELECT COUNT(*) AS records_read, COUNT(*) - COUNT(DISTINCT txn_id) AS duplicates_removed, COUNT(DISTINCT txn_id) AS records_merged,
        CAST(MAX(txn_date) AS VARCHAR) AS new_watermark, 'SUCCESS' AS status, CAST(0 AS BIGINT) AS records_without_watermark FROM fresh""",
)
def h07b(t: Tables):
    return load(t).stats.withColumn("new_watermark", F.col("new_watermark").cast("string"))


@query(
    "h08_watermark_upsert",
    f"""WITH {TXN} SELECT 'cards' AS pipeline_name, CAST(MAX(txn_date) AS VARCHAR) AS watermark_value FROM txn WHERE payment_mode = 'CARD'
        UNION ALL SELECT 'transfers', CAST(MAX(txn_date) AS VARCHAR) FROM txn WHERE payment_mode = 'NEFT'""",
)
def h08(t: Tables):
    def newest(mode, before=None):
        rows = t.txn.where(F.col("payment_mode") == mode)
        if before:
            rows = rows.where(F.col("txn_date") < before)
        return rows.agg(F.max("txn_date").alias("watermark_value"))

    table = incremental.watermark_table(t.spark)
    for pipeline, value in (("cards", newest("CARD", CUT)), ("transfers", newest("NEFT")), ("cards", newest("CARD"))):
        table = incremental.save_watermark(table, pipeline, value, moment("2024-01-01"))
    return table.select("pipeline_name", F.col("watermark_value").cast("date").cast("string").alias("watermark_value"))


@query(
    "h09_incremental_model",
    f"""WITH {TXN} SELECT CAST(txn_date AS VARCHAR) AS txn_date, payment_mode, COUNT(txn_id) AS transaction_count, ROUND(SUM(amount), 2) AS total_revenue, COUNT(DISTINCT customer_id) AS unique_customers FROM txn GROUP BY 1, 2""",
)
def h09(t: Tables):
    def build(rows):
        return rows.groupBy("txn_date", "payment_mode").agg(
            F.count("txn_id").alias("transaction_count"), F.round(F.sum("amount"), 2).alias("total_revenue"), F.countDistinct("customer_id").alias("unique_customers")
        )

    existing = build(t.txn.where((F.col("txn_date") < CUT) | ((F.col("txn_date") == CUT) & (F.col("txn_id") % 2 == 0))))
    model = incremental.incremental_model(existing, t.txn, "txn_date", build, ["txn_date", "payment_mode"], dt.date(1999, 1, 1))
    return model.withColumn("txn_date", F.col("txn_date").cast("string"))


@query("h10_late_reconciliation", f"WITH {TXN} SELECT txn_id, amount FROM txn WHERE txn_date <> DATE '1998-03-02' OR TRUE")
def h10(t: Tables):
    day = dt.date(1998, 3, 2)
    first_load = t.txn.where((F.col("txn_date") != F.lit(day)) | (F.col("txn_id") % 2 == 0))
    return incremental.reconcile_late(first_load, t.txn, ["txn_id"], "txn_date", day).select("txn_id", "amount")


@query("h11_idempotent_batches", "SELECT o_orderkey, CAST(YEAR(o_orderdate) AS VARCHAR) AS batch_id FROM orders WHERE YEAR(o_orderdate) NOT IN (1996, 1998)")
def h11(t: Tables):
    batches = t.orders.select("o_orderkey", F.year("o_orderdate").cast("string").alias("batch_id"))
    processed = batches.where(F.col("batch_id").isin("1996", "1998")).select("batch_id").distinct()
    return incremental.unprocessed(batches, processed).select("o_orderkey", "batch_id")


@query(
    "h12_pending_batch_windows",
    """WITH b AS (SELECT date_trunc('day', MIN(ts)) AS lo, date_trunc('day', MAX(ts)) AS hi FROM events),
       w AS (SELECT UNNEST(generate_series(lo, hi - INTERVAL 1 MICROSECOND, INTERVAL 6 HOUR)) AS s FROM b),
       done AS (SELECT DISTINCT time_bucket(INTERVAL 6 HOUR, ts) AS s FROM events WHERE event_type = 'signup' AND user_id % 4 = 0)
       SELECT strftime(s, '%Y-%m-%d %H:%M') AS window_start, strftime(s + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M') AS window_end FROM w WHERE s NOT IN (SELECT s FROM done)""",
)
def h12(t: Tables):
    at = F.col("ts").cast("timestamp")
    bounds = t.events.agg(F.date_trunc("day", F.min(at)).alias("lo"), F.date_trunc("day", F.max(at)).alias("hi"))
    windows = sequences.batch_windows(bounds, F.col("lo"), F.col("hi"), 6)
    ran = t.events.where("event_type = 'signup' AND user_id % 4 = 0").select(F.window(at, "6 hours").alias("w")).distinct()
    done = ran.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
    form = "yyyy-MM-dd HH:mm"
    return sequences.pending_windows(windows, done).select(
        F.date_format("window_start", form).alias("window_start"), F.date_format("window_end", form).alias("window_end")
    )
