"""Aggregations, profiles and skew reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.catalogue.registry import DIRTY, TXN, Tables, query
from lakeloom.operators import aggregates
from lakeloom.operators.ordered import attach, exact_percentiles


@query(
    "a01_basic_aggregates",
    f"""WITH {TXN} SELECT payment_mode, COUNT(*) AS n, ROUND(SUM(amount), 2) AS total, ROUND(AVG(amount), 4) AS mean,
        MIN(amount) AS lowest, MAX(amount) AS highest FROM txn GROUP BY payment_mode""",
)
def a01(t: Tables):
    return t.txn.groupBy("payment_mode").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("amount"), 2).alias("total"),
        F.round(F.avg("amount"), 4).alias("mean"),
        F.min("amount").alias("lowest"),
        F.max("amount").alias("highest"),
    )


@query(
    "a02_count_distinct",
    f"WITH {TXN} SELECT payment_mode, COUNT(DISTINCT customer_id) AS customers FROM txn GROUP BY payment_mode",
)
def a02(t: Tables):
    return t.txn.groupBy("payment_mode").agg(F.countDistinct("customer_id").alias("customers"))


@query(
    "a03_approx_count_distinct",
    "SELECT event_type, TRUE AS within_bound FROM events GROUP BY event_type",
)
def a03(t: Tables):
    """The sketch against the exact count: the error stays within four times its rsd.

    Two aggregates: in a single one, Spark would keep a sketch of 3 KB for each event identifier.
    """
    by_type = t.events.groupBy("event_type")
    sketch = by_type.agg(F.approx_count_distinct("event_id", 0.02).alias("approx"))
    both = attach(sketch, by_type.agg(F.countDistinct("event_id").alias("exact")), ["event_type"])
    error = F.abs(F.col("approx") - F.col("exact")) / F.col("exact")
    return both.select("event_type", (error <= 0.08).alias("within_bound"))


@query(
    "a04_variance_stddev",
    f"""WITH {TXN} SELECT payment_mode, ROUND(VAR_SAMP(amount) / 1e6, 4) AS variance_m, ROUND(STDDEV_SAMP(amount), 4) AS deviation
        FROM txn GROUP BY payment_mode""",
)
def a04(t: Tables):
    return t.txn.groupBy("payment_mode").agg(
        F.round(F.var_samp("amount") / 1e6, 4).alias("variance_m"),
        F.round(F.stddev_samp("amount"), 4).alias("deviation"),
    )


@query(
    "a05_collect_set",
    f"""WITH {TXN} SELECT customer_id, string_agg(DISTINCT payment_mode, ',' ORDER BY payment_mode) AS modes FROM txn GROUP BY customer_id""",
)
def a05(t: Tables):
    modes = F.array_sort(F.collect_set("payment_mode"))
    return t.txn.groupBy("customer_id").agg(F.array_join(modes, ",").alias("modes"))


@query(
    "a05_collect_list_chunked",
    """WITH p AS (SELECT l_orderkey, l_partkey, (ROW_NUMBER() OVER (PARTITION BY l_orderkey
         ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) - 1) AS pos FROM lineitem)
       SELECT l_orderkey, pos // 5 AS chunk, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY pos) AS parts
       FROM p GROUP BY 1, 2""",
)
def a05b(t: Tables):
    """Line items per order, in lists of at most five."""
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")]
    part = F.col("l_partkey").cast("string")
    lists = aggregates.collect_chunks(t.lineitem, ["l_orderkey"], part, order, size=5, block=F.col("l_linenumber"))
    return lists.select("l_orderkey", "chunk", F.array_join("items", ",").alias("parts"))


@query(
    "a06_first_last",
    f"""WITH {TXN} SELECT customer_id, arg_min(txn_id, (txn_date, txn_id)) AS first_txn, arg_max(txn_id, (txn_date, txn_id)) AS last_txn,
        arg_max(amount, (txn_date, txn_id)) AS last_amount FROM txn GROUP BY customer_id""",
)
def a06(t: Tables):
    order = F.struct("txn_date", "txn_id")
    return t.txn.groupBy("customer_id").agg(
        F.min_by("txn_id", order).alias("first_txn"),
        F.max_by("txn_id", order).alias("last_txn"),
        F.max_by("amount", order).alias("last_amount"),
    )


@query(
    "a07_conditional_aggregates",
    f"""WITH {TXN} SELECT CAST(date_trunc('month', txn_date)::DATE AS VARCHAR) AS month,
        ROUND(SUM(CASE WHEN payment_mode = 'CARD' THEN amount END), 2) AS card_revenue,
        COUNT(*) FILTER (WHERE status = 'FAILED') AS failed_count,
        COUNT(CASE WHEN amount > 400000 THEN 1 END) AS large_count FROM txn GROUP BY 1""",
)
def a07(t: Tables):
    return t.txn.groupBy(F.trunc("txn_date", "month").cast("string").alias("month")).agg(
        F.round(F.sum(F.when(F.col("payment_mode") == "CARD", F.col("amount"))), 2).alias("card_revenue"),
        aggregates.count_where(F.col("status") == "FAILED").alias("failed_count"),
        F.expr("count(*) FILTER (WHERE amount > 400000)").alias("large_count"),
    )


@query(
    "a08_global_aggregate",
    f"""WITH {TXN} SELECT COUNT(*) AS n, ROUND(SUM(amount), 2) AS total, ROUND(AVG(amount), 4) AS mean,
        COUNT(DISTINCT customer_id) AS customers FROM txn""",
)
def a08(t: Tables):
    return t.txn.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("amount"), 2).alias("total"),
        F.round(F.avg("amount"), 4).alias("mean"),
        F.countDistinct("customer_id").alias("customers"),
    )


@query(
    "a09_rollup",
    f"""WITH {TXN} SELECT payment_mode, status, CAST(GROUPING(payment_mode) * 2 + GROUPING(status) AS BIGINT) AS level,
        COUNT(*) AS n, ROUND(SUM(amount), 2) AS total FROM txn GROUP BY ROLLUP (payment_mode, status)""",
)
def a09(t: Tables):
    return t.txn.rollup("payment_mode", "status").agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total")
    )


PIVOT_SQL = f"""WITH {TXN} SELECT CAST(date_trunc('month', txn_date)::DATE AS VARCHAR) AS month,
  ROUND(SUM(CASE WHEN payment_mode = 'CARD' THEN amount END), 2) AS "CARD",
  ROUND(SUM(CASE WHEN payment_mode = 'UPI' THEN amount END), 2) AS "UPI",
  ROUND(SUM(CASE WHEN payment_mode = 'NEFT' THEN amount END), 2) AS "NEFT" FROM txn GROUP BY 1"""


@query("a10_pivot", PIVOT_SQL)
def a10(t: Tables):
    month = F.trunc("txn_date", "month").cast("string").alias("month")
    return t.txn.groupBy(month).pivot("payment_mode", ["CARD", "UPI", "NEFT"]).agg(F.round(F.sum("amount"), 2))


@query("a10_pivot_sql", PIVOT_SQL)
def a10b(t: Tables):
    t.txn.createOrReplaceTempView("loom_txn")
    return t.spark.sql(
        """SELECT * FROM (
             SELECT cast(trunc(txn_date, 'month') AS string) AS month, payment_mode, amount FROM loom_txn)
           PIVOT (round(sum(amount), 2) FOR payment_mode IN ('CARD' AS CARD, 'UPI' AS UPI, 'NEFT' AS NEFT))"""
    )


UNPIVOT_SQL = """SELECT o_orderkey, measure, value FROM (
    SELECT o_orderkey, 'price' AS measure, o_totalprice AS value FROM orders
    UNION ALL SELECT o_orderkey, 'tax', o_totalprice * 0.18 FROM orders)"""


def _wide(t: Tables):
    return t.orders.select(
        "o_orderkey", F.col("o_totalprice").alias("price"), (F.col("o_totalprice") * 0.18).alias("tax")
    )


@query("a11_unpivot", UNPIVOT_SQL)
def a11(t: Tables):
    return _wide(t).unpivot("o_orderkey", ["price", "tax"], "measure", "value")


@query("a11_unpivot_stack", UNPIVOT_SQL)
def a11b(t: Tables):
    return _wide(t).select("o_orderkey", F.stack(F.lit(2), F.lit("price"), "price", F.lit("tax"), "tax").alias("measure", "value"))


@query("a11_unpivot_sql", UNPIVOT_SQL)
def a11c(t: Tables):
    _wide(t).createOrReplaceTempView("loom_wide")
    return t.spark.sql("SELECT * FROM loom_wide UNPIVOT (value FOR measure IN (price, tax))")


@query(
    "a12_percentiles_exact",
    f"""WITH {TXN} SELECT payment_mode, ROUND(quantile_cont(amount, 0.25), 4) AS p25, ROUND(quantile_cont(amount, 0.5), 4) AS p50,
        ROUND(quantile_cont(amount, 0.75), 4) AS p75, ROUND(quantile_cont(amount, 0.95), 4) AS p95,
        ROUND(quantile_cont(amount, 0.99), 4) AS p99 FROM txn GROUP BY payment_mode""",
)
def a12(t: Tables):
    points = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
    out = exact_percentiles(t.txn, ["payment_mode"], "amount", points, block=F.floor(F.col("amount") / 1000))
    return out.select("payment_mode", *[F.round(p, 4).alias(p) for p in points])


@query(
    "a12_percentile_approx",
    f"WITH {TXN} SELECT payment_mode, COUNT(*) AS n, TRUE AS within_bound FROM txn GROUP BY payment_mode",
)
def a12b(t: Tables):
    """The median sketch: no more than half the rows, give or take 1 %, lie on either side."""
    sketch = t.txn.groupBy("payment_mode").agg(F.percentile_approx("amount", 0.5, 10_000).alias("p50"))
    sides = t.txn.join(sketch, "payment_mode").groupBy("payment_mode").agg(
        F.count(F.lit(1)).alias("n"),
        aggregates.count_where(F.col("amount") < F.col("p50")).alias("below"),
        aggregates.count_where(F.col("amount") > F.col("p50")).alias("above"),
    )
    ok = (F.col("below") <= F.col("n") * 0.51) & (F.col("above") <= F.col("n") * 0.51)
    return sides.select("payment_mode", "n", ok.alias("within_bound"))


@query(
    "a13_having_duplicates",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS occurrences FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""",
)
def a13(t: Tables):
    return aggregates.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "a14_share_of_total",
    f"""WITH {TXN} SELECT payment_mode, COUNT(*) AS row_count,
        ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2) AS pct_of_total FROM txn GROUP BY payment_mode""",
)
def a14(t: Tables):
    return aggregates.share_of_total(t.txn, ["payment_mode"])


@query(
    "a15_null_report",
    f"""WITH {DIRTY} SELECT UNNEST(['amount', 'customer_id', 'merchant_id', 'txn_id']) AS column_name,
        UNNEST([COUNT(*) - COUNT(amount), COUNT(*) - COUNT(customer_id), COUNT(*) - COUNT(merchant_id), COUNT(*) - COUNT(txn_id)]) AS null_count,
        COUNT(*) AS total_rows,
        UNNEST([ROUND((COUNT(*) - COUNT(amount)) * 100.0 / COUNT(*), 2), ROUND((COUNT(*) - COUNT(customer_id)) * 100.0 / COUNT(*), 2),
          ROUND((COUNT(*) - COUNT(merchant_id)) * 100.0 / COUNT(*), 2), ROUND((COUNT(*) - COUNT(txn_id)) * 100.0 / COUNT(*), 2)]) AS null_pct
        FROM dirty""",
)
def a15(t: Tables):
    return aggregates.null_report(t.dirty, ["txn_id", "amount", "customer_id", "merchant_id"])


@query(
    "a16_table_profile",
    f"""WITH {TXN} SELECT COUNT(*) AS total_rows, COUNT(DISTINCT customer_id) AS unique_keys, CAST(MIN(txn_date) AS VARCHAR) AS earliest_date,
        CAST(MAX(txn_date) AS VARCHAR) AS latest_date, CAST(MAX(txn_date) - MIN(txn_date) AS INT) AS date_range_days, ROUND(SUM(amount), 2) AS total_amount,
        ROUND(AVG(amount), 2) AS avg_amount, ROUND(STDDEV(amount), 2) AS std_amount, MIN(amount) AS min_amount, MAX(amount) AS max_amount,
        MEDIAN(amount) BETWEEN MIN(amount) AND MAX(amount) AS median_within_error FROM txn""",
)
def a16(t: Tables):
    """The approximate median is compared by its rank, which may be off by a ten-thousandth of the rows."""
    profile = aggregates.table_profile(t.txn, "customer_id", "txn_date", "amount")
    amount, median = F.col("amount"), F.col("median_amount")
    ranked = t.txn.select("amount").join(F.broadcast(profile.select("median_amount")))
    shares = ranked.agg(
        (F.count_if(amount < median) / F.count("amount")).alias("below"),
        (F.count_if(amount <= median) / F.count("amount")).alias("upto"),
    )
    within = (F.col("below") <= 0.5 + 1e-4) & (F.col("upto") >= 0.5 - 1e-4)
    profile = profile.drop("median_amount").join(F.broadcast(shares.select(within.alias("median_within_error"))))
    return profile.withColumns({c: F.col(c).cast("string") for c in ("earliest_date", "latest_date")})


@query(
    "a17_summary",
    """SELECT UNNEST(['count', 'min', 'max']) AS summary,
       UNNEST([CAST(COUNT(o_totalprice) AS DOUBLE), MIN(o_totalprice), MAX(o_totalprice)]) AS o_totalprice FROM orders""",
)
def a17(t: Tables):
    text = t.orders.select("o_totalprice").summary("count", "min", "max")
    return text.select("summary", F.col("o_totalprice").cast("double").alias("o_totalprice"))


@query(
    "a17_describe",
    """SELECT UNNEST(['count', 'mean', 'stddev', 'min', 'max']) AS summary,
       UNNEST([CAST(COUNT(o_totalprice) AS DOUBLE), ROUND(AVG(o_totalprice), 4), ROUND(STDDEV_SAMP(o_totalprice), 4), MIN(o_totalprice), MAX(o_totalprice)]) AS o_totalprice
       FROM orders""",
)
def a17b(t: Tables):
    text = t.orders.describe("o_totalprice")
    return text.select("summary", F.round(F.col("o_totalprice").cast("double"), 4).alias("o_totalprice"))


@query(
    "a18_word_count",
    r"""WITH w AS (SELECT UNNEST(regexp_split_to_array(text, '[ \t\n\v\f\r]+')) AS word FROM documents)
        SELECT word, COUNT(*) AS n FROM w WHERE word <> '' GROUP BY word""",
)
def a18(t: Tables):
    return aggregates.word_counts(t.documents, "text")


@query(
    "a19_key_reduce_and_group",
    """SELECT event_type, ROUND(SUM(value), 2) AS total, string_agg(DISTINCT CAST(user_id % 5 AS VARCHAR), ',' ORDER BY CAST(user_id % 5 AS VARCHAR)) AS buckets
       FROM events GROUP BY event_type""",
)
def a19(t: Tables):
    """Reduce by key, and group by key over values that were made distinct first."""
    bucket = (F.col("user_id") % 5).cast("string")
    return t.events.groupBy("event_type").agg(
        F.round(F.sum("value"), 2).alias("total"),
        F.array_join(F.array_sort(F.collect_set(bucket)), ",").alias("buckets"),
    )


@query(
    "a20_partial_final_aggregate",
    """SELECT l_returnflag, l_linestatus, ROUND(SUM(l_quantity), 2) AS sum_qty, ROUND(SUM(l_extendedprice), 2) AS sum_base,
       ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, COUNT(*) AS n FROM lineitem
       WHERE l_shipdate <= DATE '1998-09-02' GROUP BY 1, 2""",
)
def a20(t: Tables):
    return t.lineitem.where(F.col("l_shipdate") <= "1998-09-02").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("sum_base"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "a21_ntile_over_aggregate",
    f"""WITH {TXN} SELECT customer_id, ROUND(AVG(amount), 6) AS avg_amount,
        CAST(NTILE(4) OVER (ORDER BY AVG(amount) DESC, customer_id) AS INT) AS spend_quartile FROM txn GROUP BY customer_id""",
)
def a21(t: Tables):
    from lakeloom.operators.ordered import ntile, ranked

    means = t.txn.groupBy("customer_id").agg(F.avg("amount").alias("avg_amount"))
    placed = ranked(means, [], "avg_amount", "customer_id", F.floor(F.col("avg_amount") / 5000), descending=True)
    return placed.select(
        "customer_id",
        F.round("avg_amount", 6).alias("avg_amount"),
        ntile(F.col("row_number"), F.col("total"), 4).alias("spend_quartile"),
    )


@query("a22_partition_sizes", "SELECT COUNT(*) AS n, COUNT(*) > 0 AS any_partition FROM orders")
def a22(t: Tables):
    """Row counts per physical partition add up to the table."""
    sizes = aggregates.partition_sizes(t.orders.repartition(8, "o_custkey"))
    return sizes.agg(F.sum("rows").alias("n"), (F.count(F.lit(1)) > 0).alias("any_partition"))


@query(
    "a23_hot_key_report",
    """WITH c AS (SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, COUNT(*) AS n FROM events GROUP BY 1)
       SELECT user_id, n AS rows, ROUND(n / (SELECT MEDIAN(n) FROM c), 4) AS ratio_to_median FROM c""",
)
def a23(t: Tables):
    from lakeloom.catalogue.joining import skewed_events

    return aggregates.hot_key_report(skewed_events(t), "user_id")
