"""Projections, filters, set operations and sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.catalogue.registry import CUST, DIRTY, TXN, Tables, query
from lakeloom.functions import cleaning
from lakeloom.operators import sequences

# ── projections and predicates ─────────────────────────────────────────────────────────


@query(
    "p01_select_expressions",
    """SELECT o_orderkey AS txn_id, o_totalprice AS amount, o_totalprice * 1.18 AS amount_with_tax,
       UPPER(o_orderpriority) AS priority FROM orders""",
)
def p01(t: Tables):
    return t.orders.select(
        F.col("o_orderkey").alias("txn_id"),
        F.col("o_totalprice").alias("amount"),
        (F.col("o_totalprice") * 1.18).alias("amount_with_tax"),
        F.upper("o_orderpriority").alias("priority"),
    )


@query(
    "p02_select_expr",
    """SELECT o_orderkey, o_totalprice / 1000 AS amount_k,
       CASE WHEN o_totalprice > 250000 THEN 'big' ELSE 'small' END AS size FROM orders""",
)
def p02(t: Tables):
    return t.orders.selectExpr(
        "o_orderkey",
        "o_totalprice / 1000 AS amount_k",
        "CASE WHEN o_totalprice > 250000 THEN 'big' ELSE 'small' END AS size",
    )


@query(
    "p03_rename_drop",
    "SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment FROM customer",
)
def p03(t: Tables):
    renamed = t.customer.withColumnsRenamed({"c_custkey": "customer_id", "c_name": "customer_name"})
    return renamed.drop("c_nationkey", "c_acctbal")


@query(
    "p04_add_columns",
    """SELECT p_partkey, p_retailprice * 2 AS p_retailprice, 'INR' AS currency, 1 AS version
       FROM part""",
)
def p04(t: Tables):
    return t.part.select("p_partkey", "p_retailprice").withColumns(
        {"p_retailprice": F.col("p_retailprice") * 2, "currency": F.lit("INR"), "version": F.lit(1)}
    )


@query(
    "p05_amount_category",
    f"""WITH {DIRTY} SELECT txn_id, CASE WHEN amount IS NULL THEN NULL WHEN amount < 50000 THEN 'LOW'
        WHEN amount < 150000 THEN 'MEDIUM' WHEN amount < 350000 THEN 'HIGH' ELSE 'PREMIUM' END AS amount_category
        FROM dirty""",
)
def p05(t: Tables):
    category = cleaning.bucket(F.col("amount"), (50_000, 150_000, 350_000), cleaning.AMOUNT_LABELS)
    return t.dirty.select("txn_id", category.alias("amount_category"))


RAW_TEXT = """CASE WHEN o_orderkey % 11 = 0 THEN 'not_a_number' WHEN o_orderkey % 13 = 0 THEN ''
    ELSE CAST(CAST(FLOOR(o_totalprice) AS BIGINT) AS VARCHAR) || '.50' END"""


def raw_amount():
    whole = F.floor("o_totalprice").cast("bigint").cast("string")
    k = F.col("o_orderkey")
    return F.when(k % 11 == 0, "not_a_number").when(k % 13 == 0, "").otherwise(F.concat(whole, F.lit(".50")))


@query(
    "p06_safe_cast",
    f"""SELECT o_orderkey, TRY_CAST({RAW_TEXT} AS DOUBLE) AS amount,
        TRY_CAST({RAW_TEXT} AS DOUBLE) IS NOT NULL AS is_valid FROM orders""",
)
def p06(t: Tables):
    typed = t.orders.select("o_orderkey", cleaning.to_number(raw_amount()).alias("amount"))
    return typed.withColumn("is_valid", F.col("amount").isNotNull())


@query(
    "p07_money_clean",
    """SELECT o_orderkey, CAST(FLOOR(o_totalprice) AS DOUBLE) AS amount FROM orders""",
)
def p07(t: Tables):
    printed = F.concat(F.lit("₹"), F.format_number(F.floor("o_totalprice"), 0))
    return t.orders.select("o_orderkey", cleaning.to_money(printed).alias("amount"))


@query(
    "p08_standardise_codes",
    "SELECT c_custkey, UPPER(TRIM(c_mktsegment)) AS segment, LOWER(TRIM(c_name)) AS name FROM customer",
)
def p08(t: Tables):
    padded = t.customer.select(
        "c_custkey",
        F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")).alias("raw_segment"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("  ")).alias("raw_name"),
    )
    return padded.select(
        "c_custkey",
        cleaning.code(F.col("raw_segment")).alias("segment"),
        F.lower(F.trim("raw_name")).alias("name"),
    )


@query(
    "p09_filter_and_or_not",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
       WHERE (o_totalprice > 400000 AND o_orderstatus = 'F') OR NOT (o_totalprice >= 5000)""",
)
def p09(t: Tables):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    rows = t.orders.where(((price > 400_000) & (status == "F")) | ~(price >= 5_000))
    return rows.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "p10_in_between",
    """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')
       AND o_totalprice BETWEEN 100000 AND 200000""",
)
def p10(t: Tables):
    return t.orders.where(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & ~F.col("o_orderstatus").isin("P")
        & F.col("o_totalprice").between(100_000, 200_000)
    ).select("o_orderkey", "o_orderpriority", "o_totalprice")


@query(
    "p11_null_tests",
    f"""WITH {DIRTY} SELECT txn_id, amount IS NULL AS no_amount, merchant_id IS NOT NULL AS has_merchant
        FROM dirty WHERE amount IS NULL OR customer_id IS NULL OR merchant_id IS NULL""",
)
def p11(t: Tables):
    missing = F.col("amount").isNull() | F.col("customer_id").isNull() | F.col("merchant_id").isNull()
    return t.dirty.where(missing).select(
        "txn_id",
        F.col("amount").isNull().alias("no_amount"),
        F.col("merchant_id").isNotNull().alias("has_merchant"),
    )


@query(
    "p12_string_predicates",
    """SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'small') OR contains(p_name, 'widget')
       OR regexp_matches(p_brand, '^Brand#1[0-9]$')""",
)
def p12(t: Tables):
    name = F.col("p_name")
    hit = name.startswith("small") | name.contains("widget") | F.col("p_brand").rlike("^Brand#1[0-9]$")
    return t.part.where(hit).select("p_partkey", "p_name")


@query(
    "p13_null_safe_equality",
    f"""WITH {DIRTY} SELECT txn_id, customer_id IS NOT DISTINCT FROM NULL AS customer_is_null,
        merchant_id IS NOT DISTINCT FROM 'M7' AS is_m7 FROM dirty""",
)
def p13(t: Tables):
    return t.dirty.select(
        "txn_id",
        F.col("customer_id").eqNullSafe(F.lit(None)).alias("customer_is_null"),
        F.col("merchant_id").eqNullSafe("M7").alias("is_m7"),
    )


@query(
    "p14_fill_defaults",
    f"""WITH {DIRTY} SELECT txn_id, COALESCE(amount, 0.0) AS amount, COALESCE(customer_id, 'UNKNOWN') AS customer_id,
        COALESCE(merchant_id, customer_id, 'NONE') AS party FROM dirty""",
)
def p14(t: Tables):
    party = F.coalesce("merchant_id", "customer_id", F.lit("NONE")).alias("party")
    filled = t.dirty.select("txn_id", "amount", "customer_id", party)
    return filled.fillna({"amount": 0.0, "customer_id": "UNKNOWN"})


@query(
    "p15_drop_nulls",
    f"""WITH {DIRTY}, d AS (SELECT txn_id, amount, customer_id, merchant_id,
          CAST(amount IS NOT NULL AS INT) + CAST(customer_id IS NOT NULL AS INT) + CAST(merchant_id IS NOT NULL AS INT) AS filled
        FROM dirty)
        SELECT 'any' AS rule, COUNT(*) AS n FROM d WHERE filled = 3
        UNION ALL SELECT 'all', COUNT(*) FROM d WHERE filled > 0
        UNION ALL SELECT 'subset', COUNT(*) FROM d WHERE amount IS NOT NULL
        UNION ALL SELECT 'thresh', COUNT(*) FROM d WHERE filled >= 2""",
)
def p15(t: Tables):
    d = t.dirty.select("amount", "customer_id", "merchant_id")
    kinds = {
        "any": d.dropna("any"),
        "all": d.dropna("all"),
        "subset": d.dropna(subset=["amount"]),
        "thresh": d.dropna(thresh=2),
    }
    counted = [df.agg(F.lit(k).alias("rule"), F.count(F.lit(1)).alias("n")) for k, df in kinds.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2]).unionByName(counted[3])


@query(
    "p16_distinct",
    """SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders""",
)
def p16(t: Tables):
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@query(
    "p16_drop_duplicates_on_key",
    "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL",
)
def p16b(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber").dropDuplicates(["l_orderkey", "l_linenumber"])


@query(
    "p17_split_by_threshold",
    f"""WITH {TXN} SELECT 'above' AS side, COUNT(*) AS n, ROUND(SUM(amount), 2) AS total FROM txn WHERE amount > 250000
        UNION ALL SELECT 'below', COUNT(*), ROUND(SUM(amount), 2) FROM txn WHERE amount <= 250000""",
)
def p17(t: Tables):
    def size(df, side):
        return df.agg(
            F.lit(side).alias("side"), F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total")
        )

    above, below = t.txn.where("amount > 250000"), t.txn.where("amount <= 250000")
    return size(above, "above").unionByName(size(below, "below"))


@query(
    "p18_parameterised_filter",
    f"""WITH {TXN} SELECT txn_id, payment_mode, amount FROM txn
        WHERE txn_date BETWEEN DATE '1997-01-01' AND DATE '1997-03-31' AND payment_mode IN ('CARD', 'UPI')""",
)
def p18(t: Tables):
    job = {"from": "1997-01-01", "to": "1997-03-31", "modes": ["CARD", "UPI"], "status": ["All"]}
    return t.txn.where(
        F.col("txn_date").between(F.lit(job["from"]).cast("date"), F.lit(job["to"]).cast("date"))
        & cleaning.multi_select(F.col("payment_mode"), job["modes"])
        & cleaning.multi_select(F.col("status"), job["status"])
    ).select("txn_id", "payment_mode", "amount")


@query(
    "p19_guarded_ratio",
    f"""WITH {TXN} SELECT payment_mode, COUNT(*) AS n,
        ROUND(COUNT(CASE WHEN status = 'FAILED' THEN 1 END) * 100.0 / NULLIF(COUNT(*), 0), 2) AS failed_pct,
        CAST(NULL AS DOUBLE) AS never FROM txn GROUP BY payment_mode""",
)
def p19(t: Tables):
    failed = F.count(F.when(F.col("status") == "FAILED", 1))
    grouped = t.txn.groupBy("payment_mode").agg(F.count(F.lit(1)).alias("n"), failed.alias("f"))
    return grouped.select(
        "payment_mode",
        "n",
        F.round(F.col("f") * 100.0 / F.nullif("n", F.lit(0)), 2).alias("failed_pct"),
        F.try_divide(F.col("f").cast("double"), F.lit(0.0)).alias("never"),
    )


@query("p20_limited_inspection", "SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey LIMIT 5")
def p20(t: Tables):
    return t.nation.orderBy("n_nationkey").select("n_nationkey", "n_name").limit(5)


@query(
    "p21_schema_metadata",
    """WITH o AS (UNPIVOT (SELECT COUNT(COLUMNS(*)) FROM orders) ON COLUMNS(*) INTO NAME column_name VALUE filled),
         c AS (UNPIVOT (SELECT COUNT(COLUMNS(*)) FROM customer) ON COLUMNS(*) INTO NAME column_name VALUE filled),
         l AS (UNPIVOT (SELECT COUNT(COLUMNS(*)) FROM lineitem) ON COLUMNS(*) INTO NAME column_name VALUE filled)
       SELECT 'orders' AS table_name, column_name, filled FROM o UNION ALL SELECT 'customer', column_name, filled FROM c
       UNION ALL SELECT 'lineitem', column_name, filled FROM l""",
)
def p21(t: Tables):
    """Columns of three tables with the number of rows that fill them."""
    out = None
    for name in ("orders", "customer", "lineitem"):
        df = getattr(t, name)
        filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "filled")
        filled = filled.select(F.lit(name).alias("table_name"), "column_name", "filled")
        out = filled if out is None else out.unionByName(filled)
    return out


# ── set operations and sequences ───────────────────────────────────────────────────────


@query(
    "u01_union_by_position",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def u01(t: Tables):
    left = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return left.union(t.supplier.select("s_suppkey", "s_name"))


@query(
    "u02_union_by_name_missing_columns",
    """SELECT c_custkey AS id, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
       UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier""",
)
def u02(t: Tables):
    left = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    right = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"))
    return left.unionByName(right, allowMissingColumns=True)


@query(
    "u03_recursive_union_all",
    """WITH RECURSIVE months(m) AS (SELECT MIN(o_orderdate)::DATE FROM orders
         UNION ALL SELECT (m + INTERVAL 1 MONTH)::DATE FROM months
         WHERE m + INTERVAL 1 MONTH <= (SELECT MAX(o_orderdate) FROM orders))
       SELECT CAST(m AS VARCHAR) AS month_start, COUNT(o_orderkey) AS n
       FROM months LEFT JOIN orders ON date_trunc('month', o_orderdate) = m GROUP BY m""",
)
def u03(t: Tables):
    t.orders.createOrReplaceTempView("loom_orders")
    return t.spark.sql(
        """
        WITH RECURSIVE span AS (
          SELECT min(to_date(o_orderdate)) AS lo, max(to_date(o_orderdate)) AS hi FROM loom_orders
        ), months(m, hi) AS (
          SELECT lo, hi FROM span
          UNION ALL
          SELECT add_months(m, 1), hi FROM months WHERE add_months(m, 1) <= hi
        ), counted AS (
          SELECT trunc(to_date(o_orderdate), 'month') AS om, count(*) AS n FROM loom_orders GROUP BY 1
        )
        SELECT cast(m AS string) AS month_start, coalesce(n, 0) AS n FROM months LEFT JOIN counted ON m = om
        """
    )


@query(
    "u04_difference_by_key",
    """SELECT o_custkey FROM orders WHERE o_orderdate >= '1997-01-01' AND o_orderdate < '1997-02-01'
       EXCEPT SELECT o_custkey FROM orders WHERE o_orderdate >= '1997-02-01' AND o_orderdate < '1997-03-01'""",
)
def u04(t: Tables):
    day = F.col("o_orderdate")
    january = t.orders.where((day >= "1997-01-01") & (day < "1997-02-01"))
    february = t.orders.where((day >= "1997-02-01") & (day < "1997-03-01"))
    return sequences.difference_by_key(january, february, ["o_custkey"])


@query(
    "u05_missing_dates",
    """WITH b AS (SELECT MIN(o_orderdate)::DATE AS lo, MAX(o_orderdate)::DATE AS hi FROM orders),
       spine AS (SELECT UNNEST(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS d FROM b)
       SELECT CAST(d AS VARCHAR) AS missing_date FROM spine
       WHERE d NOT IN (SELECT o_orderdate::DATE FROM orders WHERE o_totalprice < 250000)
         AND d >= (SELECT MIN(o_orderdate)::DATE FROM orders WHERE o_totalprice < 250000)
         AND d <= (SELECT MAX(o_orderdate)::DATE FROM orders WHERE o_totalprice < 250000)""",
)
def u05(t: Tables):
    small = t.orders.where("o_totalprice < 250000").select(F.to_date("o_orderdate").alias("d"))
    return sequences.missing_dates(small, "d").select(F.col("missing_date").cast("string").alias("missing_date"))


HIERARCHY_SQL = """WITH RECURSIVE h AS (
     SELECT p_partkey AS node, 1 AS level, CAST(p_partkey AS VARCHAR) AS path FROM part WHERE p_partkey = 0
     UNION ALL
     SELECT p.p_partkey, h.level + 1, h.path || ' > ' || CAST(p.p_partkey AS VARCHAR)
     FROM part p JOIN h ON p.p_partkey // 10 = h.node AND p.p_partkey > 0)
   SELECT node, level, path FROM h"""


def part_tree(t: Tables):
    key = F.col("p_partkey")
    parent = F.when(key > 0, F.floor(key / 10)).alias("parent")
    return t.part.select(key.alias("id"), parent, key.cast("string").alias("label"))


@query("u06_hierarchy_by_level_joins", HIERARCHY_SQL)
def u06(t: Tables):
    return sequences.hierarchy(part_tree(t), "id", "parent", "label")


@query("u06_hierarchy_recursive_cte", HIERARCHY_SQL)
def u06b(t: Tables):
    # the default ceiling on recursive rows is meant for accidents; real trees are larger
    t.spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    part_tree(t).createOrReplaceTempView("loom_tree")
    return t.spark.sql(
        """
        WITH RECURSIVE h(node, level, path) AS (
          SELECT id, 1, label FROM loom_tree WHERE parent IS NULL
          UNION ALL
          SELECT c.id, h.level + 1, concat(h.path, ' > ', c.label)
          FROM loom_tree c JOIN h ON c.parent = h.node
        )
        SELECT node, level, path FROM h
        """
    )


@query(
    "u07_cte_pipeline",
    f"""WITH {TXN}, {CUST}, spend AS (SELECT customer_id, SUM(amount) AS total, COUNT(*) AS n FROM txn GROUP BY 1),
        tiered AS (SELECT *, CASE WHEN total >= 3000000 THEN 'GOLD' WHEN total >= 1500000 THEN 'SILVER' ELSE 'BRONZE' END AS band FROM spend)
        SELECT band, city, COUNT(*) AS customers, ROUND(AVG(total), 6) AS avg_total
        FROM tiered LEFT JOIN cust USING (customer_id) GROUP BY band, city""",
)
def u07(t: Tables):
    t.txn.createOrReplaceTempView("loom_txn")
    t.customers.createOrReplaceTempView("loom_customers")
    return t.spark.sql(
        """
        WITH spend AS (
          SELECT customer_id, sum(amount) AS total, count(*) AS n FROM loom_txn GROUP BY customer_id
        ), tiered AS (
          SELECT *, CASE WHEN total >= 3000000 THEN 'GOLD' WHEN total >= 1500000 THEN 'SILVER'
                    ELSE 'BRONZE' END AS band FROM spend
        ), enriched AS (
          SELECT band, total, city FROM tiered LEFT JOIN loom_customers USING (customer_id)
        )
        SELECT band, city, count(*) AS customers, round(avg(total), 6) AS avg_total
        FROM enriched GROUP BY band, city
        """
    )
