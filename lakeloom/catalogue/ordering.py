"""Window functions, sorting, limits and partitioning."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.catalogue.registry import DIRTY, TXN, Tables, query
from lakeloom.operators import aggregates, ordered
from lakeloom.operators.layout import cached, write_row_target
from lakeloom.session import workspace



def month():
    """Months as ordered blocks of a transaction history."""
    return F.trunc("txn_date", "month")


BY_TIME = "ORDER BY txn_date, txn_id"


def by_time():
    return [F.col("txn_date"), F.col("txn_id")]


@query(
    "w01_row_number_rank_dense_rank",
    f"""WITH {TXN} SELECT txn_id, payment_mode, ROW_NUMBER() OVER (w, txn_id) AS row_number,
        RANK() OVER (w) AS rank, DENSE_RANK() OVER (w) AS dense_rank FROM txn
        WINDOW w AS (PARTITION BY payment_mode ORDER BY FLOOR(amount / 100) DESC)""".replace(
        "ROW_NUMBER() OVER (w, txn_id)",
        "ROW_NUMBER() OVER (PARTITION BY payment_mode ORDER BY FLOOR(amount / 100) DESC, txn_id)",
    ),
)
def w01(t: Tables):
    """Ranks within five very large groups, computed over price bands in parallel."""
    rows = t.txn.select("txn_id", "payment_mode", F.floor(F.col("amount") / 100).alias("hundreds"))
    band = F.floor(F.col("hundreds") / 100)
    out = ordered.ranked(
        rows, ["payment_mode"], "hundreds", "txn_id", band, F.floor(F.col("txn_id") / 1_000_000), descending=True
    )
    return out.select("txn_id", "payment_mode", "row_number", "rank", "dense_rank")


@query(
    "w01_ranks_builtin_window",
    f"""WITH {TXN}, d AS (SELECT payment_mode, txn_date, COUNT(*) AS n FROM txn GROUP BY 1, 2)
        SELECT payment_mode, CAST(txn_date AS VARCHAR) AS txn_date, ROW_NUMBER() OVER (PARTITION BY payment_mode ORDER BY n DESC, txn_date) AS row_number,
        RANK() OVER w AS rank, DENSE_RANK() OVER w AS dense_rank FROM d WINDOW w AS (PARTITION BY payment_mode ORDER BY n DESC)""",
)
def w01b(t: Tables):
    """Days ranked by volume: one row per day and mode, so plain windows are enough."""
    daily = t.txn.groupBy("payment_mode", "txn_date").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("payment_mode").orderBy(F.desc("n"))
    unique = Window.partitionBy("payment_mode").orderBy(F.desc("n"), "txn_date")
    return daily.select(
        "payment_mode",
        F.col("txn_date").cast("string").alias("txn_date"),
        F.row_number().over(unique).cast("bigint").alias("row_number"),
        F.rank().over(w).cast("bigint").alias("rank"),
        F.dense_rank().over(w).cast("bigint").alias("dense_rank"),
    )


@query(
    "w02_latest_per_key",
    f"""WITH {TXN} SELECT customer_id, txn_id, CAST(txn_date AS VARCHAR) AS txn_date, amount FROM
        (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY txn_date DESC, txn_id DESC) AS rn FROM txn) WHERE rn = 1""",
)
def w02(t: Tables):
    latest = ordered.latest_per_key(t.txn, ["customer_id"], [F.desc("txn_date"), F.desc("txn_id")])
    return latest.select("customer_id", "txn_id", F.col("txn_date").cast("string").alias("txn_date"), "amount")


@query(
    "w03_top_n_per_group",
    f"""WITH {TXN} SELECT payment_mode, txn_id, amount FROM (SELECT *, ROW_NUMBER() OVER
        (PARTITION BY payment_mode ORDER BY amount DESC, txn_id) AS rn FROM txn) WHERE rn <= 3""",
)
def w03(t: Tables):
    top = ordered.top_n(t.txn, ["payment_mode"], [F.desc("amount"), F.col("txn_id")], 3)
    return top.select("payment_mode", "txn_id", "amount")


@query(
    "w04_nth_highest",
    f"""WITH {TXN} SELECT payment_mode, txn_id, amount FROM (SELECT *, DENSE_RANK() OVER
        (PARTITION BY payment_mode ORDER BY amount DESC) AS dr FROM txn) WHERE dr = 2""",
)
def w04(t: Tables):
    return ordered.nth_highest(t.txn, ["payment_mode"], "amount", 2).select("payment_mode", "txn_id", "amount")


@query(
    "w05_lag_lead_delta",
    f"""WITH {TXN} SELECT customer_id, txn_id, LAG(amount, 1, 0) OVER w AS previous, LEAD(amount) OVER w AS following,
        amount - LAG(amount) OVER w AS delta FROM txn WINDOW w AS (PARTITION BY customer_id {BY_TIME})""",
)
def w05(t: Tables):
    placed = ordered.row_positions(t.txn, ["customer_id"], by_time(), month())
    out = ordered.chunked_window(
        placed,
        ["customer_id"],
        {
            "previous": lambda w: F.lag("amount", 1, 0.0).over(w),
            "following": lambda w: F.lead("amount").over(w),
            "delta": lambda w: F.col("amount") - F.lag("amount").over(w),
        },
        before=1,
        after=1,
    )
    return out.select("customer_id", "txn_id", "previous", "following", "delta")


@query(
    "w06_jump_detector",
    f"""WITH {TXN} SELECT * FROM (SELECT customer_id, txn_id, amount, LAG(amount) OVER (PARTITION BY customer_id {BY_TIME}) AS previous FROM txn)
        WHERE amount > 3 * previous""",
)
def w06(t: Tables):
    placed = ordered.row_positions(t.txn, ["customer_id"], by_time(), month())
    out = ordered.chunked_window(
        placed, ["customer_id"], {"previous": lambda w: F.lag("amount").over(w)}, before=1
    )
    return out.where(F.col("amount") > 3 * F.col("previous")).select("customer_id", "txn_id", "amount", "previous")


@query(
    "w07_running_total",
    f"""WITH {TXN} SELECT payment_mode, txn_id, ROUND(SUM(amount) OVER (PARTITION BY payment_mode {BY_TIME}
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_total FROM txn""",
)
def w07(t: Tables):
    out = ordered.running_total(t.txn, ["payment_mode"], by_time(), "amount", block=month())
    return out.select("payment_mode", "txn_id", F.round("running_total", 2).alias("running_total"))


@query(
    "w08_rolling_rows",
    f"""WITH {TXN} SELECT customer_id, txn_id, ROUND(AVG(amount) OVER (PARTITION BY customer_id {BY_TIME} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS avg_3_rows,
        ROUND(AVG(amount) OVER (PARTITION BY customer_id {BY_TIME} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS avg_7_rows FROM txn""",
)
def w08(t: Tables):
    placed = ordered.row_positions(t.txn, ["customer_id"], by_time(), month())
    out = ordered.chunked_window(
        placed,
        ["customer_id"],
        {
            "avg_3_rows": lambda w: F.round(F.avg("amount").over(w.rowsBetween(-2, 0)), 6),
            "avg_7_rows": lambda w: F.round(F.avg("amount").over(w.rowsBetween(-6, 0)), 6),
        },
        before=6,
    )
    return out.select("customer_id", "txn_id", "avg_3_rows", "avg_7_rows")


@query(
    "w09_rolling_calendar_30_days",
    f"""WITH {TXN} SELECT customer_id, txn_id, COUNT(*) OVER w AS txns_30d, ROUND(SUM(amount) OVER w, 2) AS spend_30d FROM txn
        WINDOW w AS (PARTITION BY customer_id ORDER BY txn_date RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW)""",
)
def w09(t: Tables):
    day, amount = F.unix_date("txn_date"), F.col("amount")
    out = ordered.with_rolling_sums(t.txn, ["customer_id"], day, -30, 0, {"spend_30d": amount}, {"txns_30d": F.lit(1)}, span=365)
    return out.select("customer_id", "txn_id", "txns_30d", F.round("spend_30d", 2).alias("spend_30d"))


@query(
    "w09_rolling_hour",
    """SELECT event_id, user_id, COUNT(*) OVER w AS n_1h, ROUND(SUM(value) OVER w, 2) AS value_1h FROM (
         SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events)
       WINDOW w AS (PARTITION BY event_type ORDER BY s RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW)""",
)
def w09b(t: Tables):
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    out = ordered.with_rolling_sums(
        t.events, ["event_type"], second, -3600, 0, {"value_1h": F.col("value")}, {"n_1h": F.lit(1)}, span=86_400, scale=12
    )
    return out.select("event_id", "user_id", "n_1h", F.round("value_1h", 2).alias("value_1h"))


@query(
    "w10_ntile_quartile",
    f"WITH {TXN} SELECT txn_id, CAST(NTILE(4) OVER (ORDER BY amount, txn_id) AS INT) AS quartile FROM txn",
)
def w10(t: Tables):
    """Quartiles over the whole table without sorting it in one task."""
    placed = ordered.ranked(
        t.txn, [], "amount", "txn_id", F.floor(F.col("amount") / 1000), F.floor(F.col("txn_id") / 1_000_000)
    )
    return placed.select("txn_id", ordered.ntile(F.col("row_number"), F.col("total"), 4).alias("quartile"))


@query(
    "w11_percent_rank",
    f"""WITH {TXN} SELECT txn_id, ROUND(PERCENT_RANK() OVER (PARTITION BY payment_mode ORDER BY amount), 8) AS pct FROM txn""",
)
def w11(t: Tables):
    return _percent_ranks(t.txn)


def _percent_ranks(rows):
    ranks = ordered.value_ranks(rows, ["payment_mode"], "amount", F.floor(F.col("amount") / 1000), with_nulls=True)
    joined = ordered.attach(rows, ranks, ["payment_mode", "amount"])
    pct = ordered.percent_rank(F.col("rank"), F.col("total"))
    return joined.select("txn_id", F.round(pct, 8).alias("pct"))


@query(
    "w11_percent_rank_with_nulls",
    f"""WITH {DIRTY} SELECT txn_id, ROUND(PERCENT_RANK() OVER (PARTITION BY payment_mode ORDER BY amount NULLS FIRST), 8) AS pct FROM dirty""",
)
def w11b(t: Tables):
    """NULL amounts are ranked too, first as in every ascending Spark window."""
    return _percent_ranks(t.dirty)


@query(
    "w10_ntile_with_nulls",
    f"""WITH {DIRTY} SELECT txn_id, CAST(NTILE(4) OVER (ORDER BY amount NULLS FIRST, txn_id) AS INT) AS quartile,
        RANK() OVER (ORDER BY amount NULLS FIRST) AS rank, DENSE_RANK() OVER (ORDER BY amount NULLS FIRST) AS dense_rank FROM dirty""",
)
def w10b(t: Tables):
    placed = ordered.ranked(
        t.dirty, [], "amount", "txn_id", F.floor(F.col("amount") / 1000), F.floor(F.col("txn_id") / 1_000_000)
    )
    quartile = ordered.ntile(F.col("row_number"), F.col("total"), 4).alias("quartile")
    return placed.select("txn_id", quartile, "rank", "dense_rank")


@query(
    "w01_ranks_with_nulls_descending",
    f"""WITH {DIRTY} SELECT txn_id, ROW_NUMBER() OVER (PARTITION BY payment_mode ORDER BY amount DESC NULLS LAST, txn_id) AS row_number,
        RANK() OVER (PARTITION BY payment_mode ORDER BY amount DESC NULLS LAST) AS rank FROM dirty""",
)
def w01c(t: Tables):
    placed = ordered.ranked(
        t.dirty, ["payment_mode"], "amount", "txn_id", F.floor(F.col("amount") / 1000), F.floor(F.col("txn_id") / 1_000_000), descending=True
    )
    return placed.select("txn_id", "row_number", "rank")


@query(
    "w12_day_over_day",
    f"""WITH {TXN}, d AS (SELECT txn_date, SUM(amount) AS total FROM txn GROUP BY 1)
        SELECT CAST(txn_date AS VARCHAR) AS txn_date, ROUND(total, 2) AS total, ROUND(LAG(total) OVER w, 2) AS previous_row,
        ROUND((total - LAG(total) OVER w) / LAG(total) OVER w * 100, 2) + 0.0 AS change_pct,
        ROUND(LAG(total, 7) OVER w, 2) AS seven_rows_before,
        ROUND((total - LAG(total, 7) OVER w) / LAG(total, 7) OVER w * 100, 2) + 0.0 AS change_7_pct FROM d WINDOW w AS (ORDER BY txn_date)""",
)
def w12(t: Tables):
    out = aggregates.daily_comparison(t.txn, "txn_date", "amount")
    return out.withColumn("txn_date", F.col("txn_date").cast("string"))


@query(
    "w13_running_total_per_month",
    f"""WITH {TXN} SELECT payment_mode, txn_id, ROUND(SUM(amount) OVER (PARTITION BY payment_mode, YEAR(txn_date), MONTH(txn_date) {BY_TIME}
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS month_to_date FROM txn""",
)
def w13(t: Tables):
    dated = t.txn.withColumns({"y": F.year("txn_date"), "m": F.month("txn_date")})
    out = ordered.running_total(
        dated, ["payment_mode", "y", "m"], by_time(), "amount", "month_to_date", block=F.col("txn_date")
    )
    return out.select("payment_mode", "txn_id", F.round("month_to_date", 2).alias("month_to_date"))


@query(
    "w14_period_total_beside_row",
    f"""WITH {TXN}, d AS (SELECT txn_date, payment_mode, SUM(amount) AS revenue FROM txn GROUP BY 1, 2)
        SELECT CAST(txn_date AS VARCHAR) AS txn_date, payment_mode, ROUND(revenue, 2) AS revenue,
        ROUND(SUM(revenue) OVER (PARTITION BY YEAR(txn_date), MONTH(txn_date), payment_mode), 2) AS monthly_revenue FROM d""",
)
def w14(t: Tables):
    daily = t.txn.groupBy("txn_date", "payment_mode").agg(F.sum("amount").alias("revenue"))
    w = Window.partitionBy(F.year("txn_date"), F.month("txn_date"), "payment_mode")
    return daily.select(
        F.col("txn_date").cast("string").alias("txn_date"),
        "payment_mode",
        F.round("revenue", 2).alias("revenue"),
        F.round(F.sum("revenue").over(w), 2).alias("monthly_revenue"),
    )


@query(
    "w15_first_last_value",
    f"""WITH {TXN} SELECT txn_id, FIRST_VALUE(amount) OVER w AS first_amount, LAST_VALUE(amount) OVER w AS last_amount FROM txn
        WINDOW w AS (PARTITION BY customer_id {BY_TIME} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def w15(t: Tables):
    out = ordered.first_last(
        t.txn,
        ["customer_id"],
        F.struct("txn_date", "txn_id"),
        {"first_amount": ("first", "amount"), "last_amount": ("last", "amount")},
    )
    return out.select("txn_id", "first_amount", "last_amount")


@query(
    "w16_near_duplicates",
    """WITH e AS (SELECT event_id, event_type, ts, LAG(ts) OVER (PARTITION BY event_type, user_id % 20 ORDER BY ts, event_id) AS before FROM events)
       SELECT event_id, COALESCE(ts - before <= INTERVAL 5 MINUTE, FALSE) AS is_duplicate FROM e""",
)
def w16(t: Tables):
    grouped = t.events.withColumns({"ts": F.col("ts").cast("timestamp"), "g": F.col("user_id") % 20})
    out = ordered.near_duplicates(grouped, ["event_type", "g"], "ts", "event_id", seconds=300)
    return out.select("event_id", "is_duplicate")


# ── sorting, limits, partitioning, caching ─────────────────────────────────────────────


@query(
    "t01_order_by_multi_key",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey",
)
def t01(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return rows.orderBy("o_orderstatus", F.desc("o_totalprice"), "o_orderkey")


@query(
    "t02_global_top_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def t02(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


COUNT_SQL = "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_orderstatus"


@query("t03_repartition_by_key", COUNT_SQL)
def t03(t: Tables):
    return t.orders.repartition(16, "o_orderstatus", "o_orderkey").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("t04_coalesce", COUNT_SQL)
def t04(t: Tables):
    return t.orders.repartition(16).coalesce(4).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("t05_row_target_files", "SELECT COUNT(*) AS rows, 5000 AS row_limit, TRUE AS within_limit FROM orders")
def t05(t: Tables):
    """Files written with a row target hold no more than that many rows."""
    path = workspace(t.spark, "row-target")
    write_row_target(t.orders, path, 5000)
    per_file = t.spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.sum("n").alias("rows"), F.lit(5000).alias("row_limit"), (F.max("n") <= 5000).alias("within_limit")
    )


@query(
    "t06_scoped_cache",
    """SELECT 'by_status' AS report, o_orderstatus AS label, COUNT(*) AS n FROM orders GROUP BY 2
       UNION ALL SELECT 'by_priority', o_orderpriority, COUNT(*) FROM orders GROUP BY 2""",
)
def t06(t: Tables):
    """Two reports written from one cached frame, which is released before they are read."""
    path = workspace(t.spark, "cache")
    with cached(t.orders.select("o_orderstatus", "o_orderpriority")) as shared:
        for name, column in (("by_status", "o_orderstatus"), ("by_priority", "o_orderpriority")):
            report = shared.groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
            report.write.parquet(f"{path}/report={name}")
    return t.spark.read.parquet(path)


@query("t07_cache_table", COUNT_SQL)
def t07(t: Tables):
    t.orders.select("o_orderstatus").createOrReplaceTempView("loom_cached")
    t.spark.sql("CACHE LAZY TABLE loom_cached")
    out = t.spark.sql("SELECT o_orderstatus, count(*) AS n FROM loom_cached GROUP BY o_orderstatus")
    path = workspace(t.spark, "cached-table")
    out.write.parquet(path)
    t.spark.sql("UNCACHE TABLE loom_cached")
    return t.spark.read.parquet(path)
