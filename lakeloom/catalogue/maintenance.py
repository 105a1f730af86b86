"""Merge, change feeds, schema and file layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.catalogue.registry import TXN, Tables, query
from lakeloom.operators import access, changes, layout, schema
from lakeloom.operators.merge import Delete, Insert, Update, merge, merge_partitions, upsert, upsert_latest
from lakeloom.session import stage, workspace
from lakeloom.sources import tables as table_io

COLUMNS = ["txn_id", "customer_id", "txn_date", "amount", "status"]


def target(t: Tables):
    return t.txn.select(*COLUMNS)


def updates(t: Tables):
    """A merge source: every tenth row 10 % dearer, every twentieth cancelled, new keys."""
    k = F.col("txn_id")
    rows = target(t)
    changed = rows.where(k % 10 == 0).withColumn("amount", F.col("amount") * 1.1)
    cancelled = rows.where(k % 20 == 1).withColumn("status", F.lit("CANCELLED"))
    new = rows.where(k % 25 == 2).withColumn("txn_id", k + 1_000_000_000)
    return changed.unionByName(cancelled).unionByName(new)


UPDATES = f"""{TXN}, tgt AS (SELECT txn_id, customer_id, txn_date, amount, status FROM txn), upd AS (
  SELECT txn_id, customer_id, txn_date, amount * 1.1 AS amount, status FROM tgt WHERE txn_id % 10 = 0
  UNION ALL SELECT txn_id, customer_id, txn_date, amount, 'CANCELLED' FROM tgt WHERE txn_id % 20 = 1
  UNION ALL SELECT txn_id + 1000000000, customer_id, txn_date, amount, status FROM tgt WHERE txn_id % 25 = 2)"""

UPSERTED = f"""{UPDATES}, after AS (SELECT * FROM tgt WHERE txn_id NOT IN (SELECT txn_id FROM upd) UNION ALL SELECT * FROM upd)"""


def shown(df):
    """Amounts to the cent and dates as text."""
    return df.select("txn_id", "customer_id", F.col("txn_date").cast("string").alias("txn_date"), F.round("amount", 6).alias("amount"), "status")


SHOWN = "txn_id, customer_id, CAST(txn_date AS VARCHAR) AS txn_date, ROUND(amount, 6) AS amount, status"

MERGE_SQL = f"""WITH {UPDATES}, joined AS (
    SELECT t.txn_id AS t_id, s.txn_id AS s_id, s.status AS s_status, s.amount AS s_amount, t.*, s.customer_id AS s_cust, s.txn_date AS s_date
    FROM tgt t FULL JOIN upd s ON t.txn_id = s.txn_id)
  SELECT COALESCE(t_id, s_id) AS txn_id, COALESCE(customer_id, s_cust) AS customer_id, CAST(COALESCE(txn_date, s_date) AS VARCHAR) AS txn_date,
    ROUND(CASE WHEN t_id IS NOT NULL AND s_id IS NOT NULL AND s_amount <> amount THEN s_amount WHEN t_id IS NULL THEN s_amount ELSE amount END, 6) AS amount,
    CASE WHEN t_id IS NOT NULL AND s_id IS NOT NULL AND s_amount <> amount THEN 'REPRICED' WHEN t_id IS NULL THEN s_status ELSE status END AS status
  FROM joined WHERE NOT (t_id IS NOT NULL AND s_id IS NOT NULL AND s_status = 'CANCELLED') AND (t_id IS NOT NULL OR s_amount > 100000)"""

CLAUSES = [
    Delete("src.status = 'CANCELLED'"),
    Update("src.amount <> tgt.amount", {"amount": "src.amount", "status": "'REPRICED'"}),
    Insert("src.amount > 100000"),
]


@query("d01_merge_clauses", MERGE_SQL)
def d01(t: Tables):
    return shown(merge(target(t), updates(t), ["txn_id"], CLAUSES))


@query("d01_merge_small_source", MERGE_SQL)
def d01b(t: Tables):
    """The same merge with the source measured and broadcast, so the target stays in place."""
    return shown(merge(target(t), updates(t), ["txn_id"], CLAUSES, broadcast_rows=200_000))


@query("d02_upsert_all", f"WITH {UPSERTED} SELECT {SHOWN} FROM after")
def d02(t: Tables):
    return shown(upsert(target(t), updates(t), ["txn_id"]))


@query(
    "d03_merge_touched_partitions",
    f"""WITH {TXN}, tgt AS (SELECT txn_id, amount, CAST(YEAR(txn_date) AS INT) AS y FROM txn),
        upd AS (SELECT txn_id, amount + 1 AS amount, y FROM tgt WHERE y = 1996 AND txn_id % 3 = 0)
        SELECT t.y, COUNT(*) AS n, ROUND(SUM(COALESCE(u.amount, t.amount)), 2) AS total FROM tgt t LEFT JOIN upd u USING (txn_id) GROUP BY t.y""",
)
def d03(t: Tables):
    path = workspace(t.spark, "partitioned")
    rows = t.txn.select("txn_id", "amount", F.year("txn_date").alias("y"))
    table_io.write_parquet(rows, path, partition_by=["y"])
    source = rows.where("y = 1996 AND txn_id % 3 = 0").withColumn("amount", F.col("amount") + 1)
    merge_partitions(path, source, ["txn_id"], [Update(), Insert()], "y")
    done = t.spark.read.parquet(path)
    return done.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"))


@query(
    "d04_source_dedup_before_merge",
    f"""WITH {UPDATES}, dup AS (SELECT *, 1 AS seq FROM upd UNION ALL SELECT txn_id, customer_id, txn_date, amount + 5, status, 2 FROM upd),
        latest AS (SELECT * EXCLUDE (seq) FROM dup WHERE seq = 2), after AS (
        SELECT * FROM tgt WHERE txn_id NOT IN (SELECT txn_id FROM latest) UNION ALL SELECT * FROM latest) SELECT {SHOWN} FROM after""",
)
def d04(t: Tables):
    once = updates(t).withColumn("seq", F.lit(1))
    twice = once.unionByName(updates(t).withColumn("amount", F.col("amount") + 5).withColumn("seq", F.lit(2)))
    return shown(upsert_latest(target(t), twice, ["txn_id"], [F.desc("seq")]))


def snapshots(t: Tables):
    """Version 0, and version 1 with changes, deletes and new rows."""
    before = target(t)
    after = upsert(before, updates(t), ["txn_id"]).where("txn_id % 50 <> 7")
    return before, after


SNAPSHOTS = f"{UPSERTED}, v1 AS (SELECT * FROM after WHERE txn_id % 50 <> 7)"

FEED_SQL = f"""{SNAPSHOTS}, feed AS (
  SELECT b.*, 'delete' AS _change_type FROM tgt b WHERE txn_id NOT IN (SELECT txn_id FROM v1)
  UNION ALL SELECT a.*, 'insert' FROM v1 a WHERE txn_id NOT IN (SELECT txn_id FROM tgt)
  UNION ALL SELECT b.*, 'update_preimage' FROM tgt b JOIN v1 a USING (txn_id) WHERE (a.amount, a.status) IS DISTINCT FROM (b.amount, b.status)
  UNION ALL SELECT a.*, 'update_postimage' FROM tgt b JOIN v1 a USING (txn_id) WHERE (a.amount, a.status) IS DISTINCT FROM (b.amount, b.status))"""


def moment(text: str):
    return F.lit(text).cast("timestamp")


def feed(t: Tables):
    before, after = snapshots(t)
    return changes.change_feed(before, after, ["txn_id"], 1, moment("2024-01-02"))


def log(t: Tables):
    """The change log as stored data: written once for a query, however often it is read."""
    if "_change_log" not in t.__dict__:
        start = changes.initial_feed(target(t), 0, moment("2024-01-01"))
        t.__dict__["_change_log"] = stage(start.unionByName(feed(t)), "change-log")
    return t.__dict__["_change_log"]


@query("d05_change_feed", f"WITH {FEED_SQL} SELECT {SHOWN}, _change_type FROM feed")
def d05(t: Tables):
    rows = feed(t)
    return rows.select(
        "txn_id", "customer_id", F.col("txn_date").cast("string").alias("txn_date"), F.round("amount", 6).alias("amount"), "status", "_change_type"
    )


@query(
    "d06_change_feed_ranges",
    f"""WITH {FEED_SQL} SELECT 'by_version' AS how, COUNT(*) AS n FROM feed UNION ALL SELECT 'by_time', COUNT(*) FROM tgt""",
)
def d06(t: Tables):
    everything = log(t)
    by_version = changes.changes_between(everything, start_version=1)
    by_time = changes.changes_between(everything, end_time=moment("2024-01-01 12:00:00"))
    n = F.count(F.lit(1)).alias("n")
    return by_version.agg(F.lit("by_version").alias("how"), n).unionByName(by_time.agg(F.lit("by_time").alias("how"), n))


@query("d07_time_travel_latest", f"WITH {SNAPSHOTS} SELECT {SHOWN} FROM v1")
def d07(t: Tables):
    return shown(changes.replay(log(t), ["txn_id"], version=1))


@query("d07_time_travel_by_timestamp", f"WITH {SNAPSHOTS} SELECT {SHOWN} FROM tgt")
def d07b(t: Tables):
    return shown(changes.replay(log(t), ["txn_id"], at=moment("2024-01-01 12:00:00")))


@query(
    "d08_restore_deleted_rows",
    f"WITH {SNAPSHOTS}, r AS (SELECT * FROM v1 UNION ALL SELECT * FROM tgt WHERE txn_id NOT IN (SELECT txn_id FROM v1)) SELECT {SHOWN} FROM r",
)
def d08(t: Tables):
    current = changes.replay(log(t), ["txn_id"], version=1)
    return shown(changes.recover_deleted(current, log(t), ["txn_id"], 0))


@query(
    "d09_version_compare",
    f"""WITH {FEED_SQL} SELECT _change_type, COUNT(*) AS n, ROUND(SUM(amount), 2) AS total FROM feed WHERE _change_type <> 'update_preimage' GROUP BY 1""",
)
def d09(t: Tables):
    old, new = (stage(changes.replay(log(t), ["txn_id"], version=v), "version") for v in (0, 1))
    compared = changes.compare_versions(old, new, ["txn_id"], 1, moment("2024-01-02"))
    return (
        compared.where("_change_type <> 'update_preimage'")
        .groupBy("_change_type")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"))
    )


@query(
    "d10_change_summary",
    f"""WITH {FEED_SQL} SELECT CAST(0 AS BIGINT) AS _commit_version, 'insert' AS _change_type, COUNT(*) AS rows FROM tgt
        UNION ALL SELECT 1, _change_type, COUNT(*) FROM feed GROUP BY _change_type""",
)
def d10(t: Tables):
    return changes.change_summary(log(t))


def gold_aggregates():
    return [
        F.count("txn_id").alias("lifetime_transactions"),
        F.round(F.sum("amount"), 4).alias("lifetime_spend"),
        F.max("txn_date").cast("string").alias("last_transaction_date"),
    ]


@query(
    "d11_incremental_gold",
    f"""WITH {SNAPSHOTS} SELECT customer_id, COUNT(txn_id) AS lifetime_transactions, ROUND(SUM(amount), 4) AS lifetime_spend,
        CAST(MAX(txn_date) AS VARCHAR) AS last_transaction_date FROM v1 GROUP BY customer_id""",
)
def d11(t: Tables):
    before, after = snapshots(t)
    gold = before.groupBy("customer_id").agg(*gold_aggregates())
    return changes.refresh_aggregate(gold, after, feed(t), ["customer_id"], gold_aggregates())


@query(
    "d13_schema_evolution",
    f"""WITH {TXN} SELECT txn_id, amount, NULL AS channel FROM txn WHERE txn_id % 2 = 0
        UNION ALL SELECT txn_id, NULL, 'WEB' FROM txn WHERE txn_id % 2 = 1""",
)
def d13(t: Tables):
    old = t.txn.where("txn_id % 2 = 0").select("txn_id", "amount")
    new = t.txn.where("txn_id % 2 = 1").select("txn_id", F.lit("WEB").alias("channel"))
    return schema.append_evolving(old, new)


@query(
    "d13_merge_with_new_column",
    f"""WITH {TXN} SELECT txn_id, amount, CASE WHEN txn_id % 4 = 0 THEN 'CHECKED' END AS review FROM txn""",
)
def d13b(t: Tables):
    old = t.txn.select("txn_id", "amount")
    scored = old.where("txn_id % 4 = 0").withColumn("review", F.lit("CHECKED"))
    return upsert(old, scored, ["txn_id"], evolve=True)


@query(
    "d14_schema_report",
    """SELECT 'o_clerk' AS column_name, 'missing' AS issue, 0::BIGINT AS values_at_stake UNION ALL SELECT 'o_custkey', 'type_changed', COUNT(o_custkey) FROM orders
       UNION ALL SELECT 'o_orderkey', 'type_changed', COUNT(o_orderkey) FROM orders UNION ALL SELECT 'o_orderstatus', 'extra', COUNT(o_orderstatus) FROM orders""",
)
def d14(t: Tables):
    """Deviations from the expected schema, and how many values of the table each concerns."""
    wanted = t.orders.select(
        F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("int"), F.lit("x").alias("o_clerk"), "o_totalprice", "o_orderdate", "o_orderpriority"
    ).schema
    report = schema.schema_report(wanted, t.orders).select("column_name", "issue")
    filled = t.orders.agg(*[F.count(c).alias(c) for c in t.orders.columns])
    filled = filled.unpivot([], t.orders.columns, "column_name", "values_at_stake")
    return report.join(filled, "column_name", "left").withColumn("values_at_stake", F.coalesce("values_at_stake", F.lit(0)))


@query(
    "d15_alter_columns",
    f"WITH {TXN} SELECT txn_id, customer_id AS client_id, CAST(CAST(amount AS DECIMAL(18, 2)) AS VARCHAR) AS amount, NULL::VARCHAR AS region FROM txn",
)
def d15(t: Tables):
    changed = schema.alter_columns(
        t.txn.select("txn_id", "customer_id", "amount"),
        add={"region": "string"}, rename={"customer_id": "client_id"}, retype={"amount": "decimal(18,2)"},
    )
    return changed.withColumn("amount", F.col("amount").cast("string"))


CONSTRAINTS = {"has_id": "txn_id IS NOT NULL", "positive_amount": "amount > 0", "known_mode": "payment_mode IN ('CARD', 'UPI', 'NETBANKING', 'NEFT', 'WALLET')"}


@query(
    "d16_constraint_violations",
    """SELECT UNNEST(['has_id', 'positive_amount', 'known_mode']) AS constraint_name, UNNEST([
       CAST(0 AS BIGINT), COUNT(*) FILTER (WHERE o_orderkey % 97 = 1 OR o_orderkey % 89 = 2), COUNT(*) FILTER (WHERE o_orderkey % 71 = 5)]) AS violations FROM orders""",
)
def d16(t: Tables):
    return schema.constraint_violations(t.dirty, CONSTRAINTS)


@query("d16_checked_write", f"WITH {TXN} SELECT payment_mode, COUNT(*) AS n FROM txn GROUP BY payment_mode")
def d16b(t: Tables):
    """Valid rows pass a write whose plan rejects the whole batch at the first bad one."""
    path = workspace(t.spark, "constrained")
    schema.checked_write(t.txn, CONSTRAINTS).write.parquet(path)
    return t.spark.read.parquet(path).groupBy("payment_mode").agg(F.count(F.lit(1)).alias("n"))


@query(
    "d17_generated_columns",
    f"""WITH {TXN} SELECT CAST(YEAR(txn_date) AS INT) AS txn_year, CAST(MONTH(txn_date) AS INT) AS txn_month,
        CASE WHEN amount < 100000 THEN 'LOW' WHEN amount < 300000 THEN 'MEDIUM' ELSE 'HIGH' END AS amount_bucket, COUNT(*) AS n FROM txn GROUP BY ALL""",
)
def d17(t: Tables):
    made = schema.generate_columns(
        t.txn.select("txn_id", "txn_ts", "amount"),
        {
            "txn_day": "to_date(txn_ts)",
            "txn_year": "year(txn_day)",
            "txn_month": "month(txn_day)",
            "amount_bucket": "CASE WHEN amount < 100000 THEN 'LOW' WHEN amount < 300000 THEN 'MEDIUM' ELSE 'HIGH' END",
        },
    )
    path = workspace(t.spark, "generated")
    table_io.write_parquet(made.hint("rebalance", "txn_year"), path, partition_by=["txn_year"])
    return t.spark.read.parquet(path).groupBy("txn_year", "txn_month", "amount_bucket").agg(F.count(F.lit(1)).alias("n"))


@query(
    "d18_compaction",
    "SELECT COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total, TRUE AS fewer_files FROM orders",
)
def d18(t: Tables):
    small, large = workspace(t.spark, "small-files"), workspace(t.spark, "compacted")
    t.orders.repartition(24).write.parquet(small)
    layout.compact(t.spark, small, large, 64 * 1024 * 1024)
    before = layout.file_sizes(t.spark, small).agg(F.count(F.lit(1)).alias("b"))
    after = layout.file_sizes(t.spark, large).agg(F.count(F.lit(1)).alias("a"))
    return t.spark.read.parquet(large).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), (F.first(after.scalar()) < F.first(before.scalar())).alias("fewer_files")
    )


def clustered_path(t: Tables) -> str:
    path = workspace(t.spark, "z-order")
    rows = t.txn.select("txn_id", "amount", F.unix_date("txn_date").alias("day"), "customer_id")
    layout.z_cluster(rows, ["day", "amount"], files=64).write.parquet(path)
    return path


@query("d19_z_order", "SELECT COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total, 0 AS overlaps, TRUE AS files_follow_bytes FROM orders")
def d19(t: Tables):
    """Files of about 64 KB; their stretches of the curve follow one another."""
    source, path, by = workspace(t.spark, "unsorted"), workspace(t.spark, "z-order"), ["day", "amount"]
    t.txn.select("txn_id", "amount", F.unix_date("txn_date").alias("day"), "customer_id").write.parquet(source)
    bounds = stage(layout.z_bounds(t.spark.read.parquet(source), by), "z-bounds")
    wanted = layout.z_rewrite(t.spark, source, path, by, bounds, file_bytes=64 * 1024)
    order = layout.curve_overlaps(t.spark, path, by, bounds)
    fits = ((F.col("files") <= wanted) & (F.col("files") > wanted / 2)).alias("files_follow_bytes")
    sums = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"))
    return sums.join(F.broadcast(order.select(F.col("overlaps").cast("int").alias("overlaps"), fits)))


@query("d20_files_met_by_predicate", "SELECT UNNEST(['amount', 'day']) AS column_name, TRUE AS skips_half FROM (SELECT 1 FROM orders LIMIT 1)")
def d20(t: Tables):
    """After clustering, a narrow range on either column opens fewer than half of the files."""
    ranges = layout.column_ranges(t.spark, clustered_path(t), ["day", "amount"])
    skips = (F.col("files_met") < F.col("files") / 2).alias("skips_half")
    by_day = layout.files_met(ranges, "day", F.lit(10000), F.lit(10030))
    by_amount = layout.files_met(ranges, "amount", F.lit(200000.0), F.lit(205000.0))
    return by_day.select(F.lit("day").alias("column_name"), skips).unionByName(by_amount.select(F.lit("amount").alias("column_name"), skips))


@query(
    "d20_files_met_by_month",
    f"""WITH {TXN}, f AS (SELECT MIN(txn_date - DATE '1970-01-01') AS d0, MAX(txn_date - DATE '1970-01-01') AS d1, MIN(amount) AS a0, MAX(amount) AS a1 FROM txn GROUP BY date_trunc('month', txn_date))
        SELECT 'day' AS column_name, COUNT(*) AS files, COUNT(*) FILTER (WHERE d0 <= 10030 AND d1 >= 9980) AS files_met FROM f
        UNION ALL SELECT 'amount', COUNT(*), COUNT(*) FILTER (WHERE a0 <= 1200 AND a1 >= 900) FROM f""",
)
def d20b(t: Tables):
    """One file a month: how many a range of days and one of amounts would open, from the footers."""
    path = workspace(t.spark, "by-month")
    rows = t.txn.select("amount", F.unix_date("txn_date").alias("day"), F.date_format("txn_date", "yyyy-MM").alias("month"))
    rows.repartition("month").write.partitionBy("month").parquet(path)
    ranges = layout.footer_ranges(t.spark, path, ["day", "amount"])
    met = {"day": layout.files_met(ranges, "day", F.lit(9980), F.lit(10030)), "amount": layout.files_met(ranges, "amount", F.lit(900.0), F.lit(1200.0))}
    by_day, by_amount = (df.select(F.lit(name).alias("column_name"), "files", "files_met") for name, df in met.items())
    return by_day.unionByName(by_amount)


@query(
    "d20_footer_statistics",
    """SELECT SUM(n)::BIGINT AS rows, MIN(a) AS lo_price, MAX(b) AS hi_price, MIN(c) AS lo_key, MAX(d) AS hi_key, MIN(e) AS lo_priority, MAX(f) AS hi_priority FROM (
         SELECT COUNT(*) AS n, MIN(o_totalprice) AS a, MAX(o_totalprice) AS b, MIN(o_custkey) AS c, MAX(o_custkey) AS d, MIN(o_orderpriority) AS e, MAX(o_orderpriority) AS f FROM orders GROUP BY o_orderkey % 7)""",
)
def d20c(t: Tables):
    path = workspace(t.spark, "footers")
    t.orders.repartition(7).write.parquet(path)
    ranges = layout.footer_ranges(t.spark, path, ["o_totalprice", "o_custkey", "o_orderpriority"])
    ends = {"price": "o_totalprice", "key": "o_custkey", "priority": "o_orderpriority"}
    return ranges.agg(
        F.sum("rows").alias("rows"),
        *[f(f"{side}_{c}").alias(f"{out}_{name}") for name, c in ends.items() for side, f, out in (("min", F.min, "lo"), ("max", F.max, "hi"))],
    )


@query(
    "d21_partition_advice",
    f"""WITH {TXN}, c AS (SELECT COUNT(*) AS n, UNNEST(['currency', 'customer_id', 'payment_mode', 'txn_id']) AS column_name,
          UNNEST([COUNT(DISTINCT currency), COUNT(DISTINCT customer_id), COUNT(DISTINCT payment_mode), COUNT(DISTINCT txn_id)]) AS d FROM txn)
        SELECT column_name, CASE WHEN d <= 1 THEN 'none' WHEN d <= 50 AND n * 1.0 / d >= 100 THEN 'partition' ELSE 'cluster' END AS advice FROM c""",
)
def d21(t: Tables):
    out = layout.partition_advice(t.txn, ["payment_mode", "currency", "customer_id", "txn_id"], max_values=50, min_rows=100)
    return out.select("column_name", "advice")


@query(
    "d22_archive_split",
    f"""WITH {TXN} SELECT CASE WHEN txn_date < DATE '1997-01-01' THEN 'archive' ELSE 'hot' END AS part, COUNT(*) AS n, ROUND(SUM(amount), 2) AS total FROM txn GROUP BY 1""",
)
def d22(t: Tables):
    path = workspace(t.spark, "archive")
    old, hot = layout.archive_split(t.txn, F.col("txn_date") < F.lit("1997-01-01").cast("date"))
    old.write.parquet(f"{path}/part=archive")
    hot.write.parquet(f"{path}/part=hot")
    both = t.spark.read.parquet(path)
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"))


@query("d23_copy_and_sync", f"WITH {UPSERTED}, c AS (SELECT * FROM after WHERE status <> 'FAILED') SELECT {SHOWN} FROM c")
def d23(t: Tables):
    """A filtered copy, then brought up to date from the change feed of its source."""
    keep = F.col("status") != "FAILED"
    copy = stage(target(t).where(keep), "copy")
    now = upsert(target(t), updates(t), ["txn_id"])
    delta = changes.change_feed(target(t).where(keep), now.where(keep), ["txn_id"], 1, moment("2024-01-02"))
    newest = delta.where("_change_type <> 'update_preimage'").drop("_commit_version", "_commit_timestamp")
    plain = {c: f"src.{c}" for c in COLUMNS}
    synced = merge(copy, newest, ["txn_id"], [Delete("src._change_type = 'delete'"), Update(set=plain), Insert("src._change_type <> 'delete'", plain)])
    return shown(synced)


@query("d24_column_statistics", "SELECT 'o_custkey' AS col_name, COUNT(*) AS row_count, MIN(o_custkey) AS lo, MAX(o_custkey) AS hi FROM orders")
def d24(t: Tables):
    path = workspace(t.spark, "stats")
    name = f"loom_stats_{path.rsplit('-', 1)[1]}"
    table_io.save_external(t.orders, name, path)
    table_io.column_statistics(t.spark, name, ["o_custkey", "o_totalprice"])
    described = t.spark.sql(f"DESCRIBE EXTENDED {name} o_custkey")
    value = {n: F.max(F.when(F.col("info_name") == n, F.col("info_value"))) for n in ("col_name", "min", "max")}
    stats = described.agg(value["col_name"].alias("col_name"), value["min"].cast("bigint").alias("lo"), value["max"].cast("bigint").alias("hi"))
    rows = t.spark.table(name).agg(F.count(F.lit(1)).alias("row_count")).scalar()
    return stats.withColumn("row_count", rows)


@query(
    "d25_right_to_erasure",
    f"""WITH {TXN}, ids AS (SELECT customer_id FROM txn WHERE txn_id % 100 = 3) SELECT 'silver' AS layer, COUNT(*) AS rows_deleted FROM txn WHERE customer_id IN (SELECT customer_id FROM ids)
        UNION ALL SELECT 'gold', COUNT(DISTINCT customer_id) FROM txn WHERE customer_id IN (SELECT customer_id FROM ids)
        UNION ALL SELECT 'left_in_silver', COUNT(*) FROM txn WHERE customer_id NOT IN (SELECT customer_id FROM ids)""",
)
def d25(t: Tables):
    requests = t.txn.where("txn_id % 100 = 3").select("customer_id")
    gold = t.txn.groupBy("customer_id").agg(F.sum("amount").alias("spend"))
    kept, deletions = access.erase({"silver": t.txn, "gold": gold}, "customer_id", requests)
    left = kept["silver"].agg(F.lit("left_in_silver").alias("layer"), F.count(F.lit(1)).alias("rows_deleted"))
    return deletions.unionByName(left)


@query(
    "d25_erasure_in_files",
    f"""WITH {TXN}, ids AS (SELECT customer_id FROM txn WHERE txn_id % 1000 = 3), o AS (SELECT *, CAST(YEAR(txn_date) AS INT) AS y FROM txn)
        SELECT y, COUNT(*) FILTER (WHERE customer_id IN (SELECT customer_id FROM ids)) AS rows_deleted, COUNT(*) FILTER (WHERE customer_id NOT IN (SELECT customer_id FROM ids)) AS rows_left,
          TRUE AS others_untouched FROM o GROUP BY y""",
)
def d25b(t: Tables):
    """Only files that hold a requested customer are rewritten, in a table partitioned by year."""
    path = workspace(t.spark, "erasable")
    rows = t.txn.withColumn("y", F.year("txn_date"))
    rows.repartitionByRange(8, "customer_id").write.partitionBy("y").parquet(path)
    files = lambda: t.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(
        f"{path}/y=*"
    ).select(F.regexp_extract("path", "[^/]+/[^/]+$", 0).alias("file"), "modificationTime")
    before = stage(files(), "files")
    erased = access.erase_files(t.spark, path, "customer_id", t.txn.where("txn_id % 1000 = 3").select("customer_id"), "request-1", ["y"])
    touched = erased.select(F.regexp_extract("file_path", "[^/]+/[^/]+$", 0).alias("file"), "rows_deleted")
    gone = before.join(files(), ["file", "modificationTime"], "left_anti")
    wrong = gone.join(touched, "file", "left_anti").agg((F.count(F.lit(1)) == 0).alias("others_untouched"))
    deleted = touched.groupBy(F.regexp_extract("file", "y=([0-9]+)", 1).cast("int").alias("y")).agg(F.sum("rows_deleted").alias("rows_deleted"))
    left = t.spark.read.parquet(path).groupBy("y").agg(F.count(F.lit(1)).alias("rows_left"))
    return left.join(deleted, "y", "left").select("y", F.coalesce("rows_deleted", F.lit(0)).alias("rows_deleted"), "rows_left").join(F.broadcast(wrong))
