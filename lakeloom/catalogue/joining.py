"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.catalogue.registry import CUST, DIRTY, TXN, Tables, query
from lakeloom.operators import changes, joins
from lakeloom.session import workspace
from lakeloom.sources import tables as table_io


@query(
    "j01_inner",
    f"""WITH {TXN}, {CUST} SELECT txn_id, customer_id, city, amount FROM txn JOIN cust USING (customer_id)
        WHERE amount > 300000""",
)
def j01(t: Tables):
    big = t.txn.where("amount > 300000")
    return big.join(t.customers, "customer_id").select("txn_id", "customer_id", "city", "amount")


def rich_customers(t: Tables):
    return t.customer.where("c_acctbal > 5000").select("c_custkey", "c_acctbal")


def big_orders(t: Tables):
    return t.orders.where("o_totalprice > 450000").select("o_orderkey", "o_custkey")


OUTER_SQL = """SELECT o_orderkey, o_custkey, c_custkey, c_acctbal
  FROM (SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 450000) o
  {how} JOIN (SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 5000) c ON o_custkey = c_custkey"""


@query("j02_left_outer", OUTER_SQL.format(how="LEFT"))
def j02_left(t: Tables):
    return big_orders(t).join(rich_customers(t), F.col("o_custkey") == F.col("c_custkey"), "left")


@query("j02_right_outer", OUTER_SQL.format(how="RIGHT"))
def j02_right(t: Tables):
    return big_orders(t).join(rich_customers(t), F.col("o_custkey") == F.col("c_custkey"), "right")


@query("j02_full_outer", OUTER_SQL.format(how="FULL"))
def j02_full(t: Tables):
    return big_orders(t).join(rich_customers(t), F.col("o_custkey") == F.col("c_custkey"), "full")


@query(
    "j03_left_semi",
    """SELECT c_custkey, c_name FROM customer WHERE EXISTS
       (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 480000)""",
)
def j03(t: Tables):
    big = t.orders.where("o_totalprice > 480000")
    matched = t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    return matched.select("c_custkey", "c_name")


@query(
    "j04_left_anti",
    """SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS
       (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)""",
)
def j04(t: Tables):
    big = t.orders.where("o_totalprice > 300000")
    return t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query(
    "j05_cross",
    "SELECT r_name, o_orderpriority FROM region, (SELECT DISTINCT o_orderpriority FROM orders)",
)
def j05(t: Tables):
    """Two code lists of fixed size; a cross join is right for nothing larger."""
    return t.region.select("r_name").crossJoin(t.orders.select("o_orderpriority").distinct())


@query(
    "j06_multi_key",
    """WITH first AS (SELECT l_orderkey, l_suppkey, SUM(l_quantity) AS qty FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2),
       second AS (SELECT l_orderkey AS ok, l_suppkey AS sk, SUM(l_quantity) AS other_qty FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2)
       SELECT l_orderkey, l_suppkey, qty, other_qty FROM first JOIN second ON l_orderkey = ok AND l_suppkey = sk""",
)
def j06(t: Tables):
    def part(flag, *names):
        picked = t.lineitem.where(F.col("l_returnflag") == flag).groupBy("l_orderkey", "l_suppkey")
        return picked.agg(F.sum("l_quantity").alias(names[2])).toDF(*names)

    first, second = part("A", "l_orderkey", "l_suppkey", "qty"), part("N", "ok", "sk", "other_qty")
    return first.join(second, (F.col("l_orderkey") == F.col("ok")) & (F.col("l_suppkey") == F.col("sk"))).drop("ok", "sk")


@query(
    "j07_equi_plus_range",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate::DATE AS VARCHAR) AS ship_day FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       AND l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 30 DAY""",
)
def j07(t: Tables):
    pairs = t.lineitem.join(
        t.orders,
        (F.col("l_orderkey") == F.col("o_orderkey"))
        & (F.col("l_shipdate") >= F.col("o_orderdate"))
        & (F.col("l_shipdate") < F.col("o_orderdate") + F.expr("interval 30 days")),
    )
    return pairs.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").cast("string").alias("ship_day")
    )


def price_history(t: Tables):
    """Three half-open price periods per part."""
    first = F.to_date(F.lit("1994-01-01"))
    starts = F.array(first, F.to_date(F.lit("1997-01-01")), F.date_add(F.to_date(F.lit("1999-01-01")), F.pmod("p_partkey", F.lit(30)).cast("int")))
    return (
        t.part.select("p_partkey", "p_retailprice", F.posexplode(starts).alias("n", "valid_from"), starts.alias("s"))
        .withColumn("valid_to", F.get("s", F.col("n") + 1))
        .withColumn("price", F.round(F.col("p_retailprice") * (F.col("n") * 0.1 + 1), 2))
        .select("p_partkey", "price", "valid_from", "valid_to")
    )


ASOF_SQL = """WITH starts AS (SELECT p_partkey, p_retailprice, UNNEST([0, 1, 2]) AS n FROM part),
  h0 AS (SELECT p_partkey, n, ROUND(p_retailprice * (n * 0.1::DOUBLE + 1), 2) AS price,
    CASE n WHEN 0 THEN DATE '1994-01-01' WHEN 1 THEN DATE '1997-01-01' ELSE DATE '1999-01-01' + CAST(p_partkey % 30 AS INT) END AS valid_from FROM starts),
  h AS (SELECT p_partkey, price, valid_from, LEAD(valid_from) OVER (PARTITION BY p_partkey ORDER BY n) AS valid_to FROM h0)
  SELECT l_orderkey, l_linenumber, l_partkey, price, COUNT(*) AS n
  FROM lineitem LEFT JOIN h ON l_partkey = p_partkey AND l_shipdate >= valid_from AND (valid_to IS NULL OR l_shipdate < valid_to)
  GROUP BY ALL"""


def _asof(t: Tables, **how):
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("day"))
    history = price_history(t).withColumnRenamed("p_partkey", "l_partkey")
    joined = joins.as_of_join(facts, history, "l_partkey", "day", ["price"], **how)
    return joined.groupBy("l_orderkey", "l_linenumber", "l_partkey", "price").agg(F.count(F.lit(1)).alias("n"))


@query("j08_as_of_join", ASOF_SQL)
def j08(t: Tables):
    return _asof(t)


@query("j08_as_of_join_sliced", ASOF_SQL)
def j08b(t: Tables):
    return _asof(t, slice_days=90, horizon=F.lit("2002-01-01").cast("date"))


@query(
    "j09_null_safe",
    f"""WITH {DIRTY}, keys AS (SELECT DISTINCT merchant_id FROM dirty WHERE merchant_id IS NULL OR merchant_id IN ('M1', 'M2'))
        SELECT txn_id, dirty.merchant_id FROM dirty JOIN keys ON dirty.merchant_id IS NOT DISTINCT FROM keys.merchant_id""",
)
def j09(t: Tables):
    wanted = F.col("merchant_id").isNull() | F.col("merchant_id").isin("M1", "M2")
    keys = t.dirty.where(wanted).select(F.col("merchant_id").alias("m")).distinct()
    return t.dirty.join(keys, F.col("merchant_id").eqNullSafe(F.col("m"))).select("txn_id", "merchant_id")


NATION_SQL = """SELECT n_name, COUNT(*) AS customers, ROUND(SUM(c_acctbal), 2) AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""


def _nation_report(df):
    return df.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@query("j10_broadcast_checked", NATION_SQL)
def j10(t: Tables):
    dim = joins.broadcast_if_small(t.nation, max_rows=10_000)
    return _nation_report(t.customer.join(dim, F.col("c_nationkey") == F.col("n_nationkey")))


@query("j10_broadcast_sql_hint", NATION_SQL)
def j10b(t: Tables):
    t.customer.createOrReplaceTempView("loom_customer")
    t.nation.createOrReplaceTempView("loom_nation")
    rows, size = joins.measured_size(t.nation)
    hint = "/*+ BROADCAST(n) */" if rows <= 10_000 and size <= 8 * 1024 * 1024 else ""
    return t.spark.sql(
        f"""SELECT {hint} n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
            FROM loom_customer c JOIN loom_nation n ON c_nationkey = n_nationkey GROUP BY n_name"""
    )


REVENUE_SQL = """SELECT o_orderpriority, COUNT(*) AS lines, ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS revenue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority"""


def _revenue(df):
    return df.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("lines"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
    )


@query("j11_sort_merge", REVENUE_SQL)
def j11(t: Tables):
    orders = t.orders.hint("merge")
    return _revenue(t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")))


@query("j12_bucketed", REVENUE_SQL)
def j12(t: Tables):
    """Two tables bucketed alike: the join itself needs no exchange."""
    path = workspace(t.spark, "bucketed")
    suffix = path.rsplit("-", 1)[1]
    left, right = f"loom_lines_{suffix}", f"loom_orders_{suffix}"
    lines = t.lineitem.select("l_orderkey", "l_extendedprice", "l_discount")
    table_io.write_bucketed(lines, left, 8, ["l_orderkey"], f"{path}/lines")
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    table_io.write_bucketed(orders, right, 8, ["o_orderkey"], f"{path}/orders")
    joined = t.spark.table(left).join(t.spark.table(right), F.col("l_orderkey") == F.col("o_orderkey"))
    return _revenue(joined)


SKEW_SQL = """WITH skewed AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, value FROM events),
  users AS (SELECT DISTINCT user_id, 'U' || CAST(user_id AS VARCHAR) AS label FROM events)
  SELECT label, COUNT(*) AS n, ROUND(SUM(value), 2) AS total FROM skewed JOIN users USING (user_id) GROUP BY label"""


def skewed_events(t: Tables):
    """One user owns a third of all events."""
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("user_id"))
    return t.events.select("event_id", hot.alias("user_id"), "value")


def users(t: Tables):
    return t.events.select("user_id").distinct().withColumn("label", F.concat(F.lit("U"), F.col("user_id").cast("string")))


def _by_label(df):
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("j13_salted_skew", SKEW_SQL)
def j13(t: Tables):
    return _by_label(joins.salted_join(skewed_events(t), users(t), "user_id", ["event_id"], salts=8, share=0.05))


@query("j14_hot_key_split", SKEW_SQL)
def j14(t: Tables):
    return _by_label(joins.hot_split_join(skewed_events(t), users(t), "user_id", share=0.05))


@query(
    "j18_version_diff",
    """SELECT p_partkey, p_name FROM part WHERE p_partkey % 7 <> 0""",
)
def j18(t: Tables):
    """Rows of the new version that the old one (every seventh part) does not have."""
    old = t.part.where(F.col("p_partkey") % 7 == 0)
    return changes.difference(t.part, old, ["p_partkey"]).select("p_partkey", "p_name")


@query(
    "j19_using_clause",
    f"""WITH {TXN}, {CUST} SELECT city, COUNT(*) AS n FROM txn JOIN cust USING (customer_id) GROUP BY city""",
)
def j19(t: Tables):
    t.txn.createOrReplaceTempView("loom_txn")
    t.customers.createOrReplaceTempView("loom_customers")
    return t.spark.sql("SELECT city, count(*) AS n FROM loom_txn JOIN loom_customers USING (customer_id) GROUP BY city")
