"""Data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.catalogue.registry import DIRTY, TXN, Tables, query
from lakeloom.operators import aggregates
from lakeloom.operators import quality as dq
from lakeloom.session import workspace

AS_OF = "2001-08-01"
MODES = ("CARD", "UPI", "NETBANKING", "NEFT", "RTGS", "IMPS", "WALLET")

# The standard rules in DuckDB syntax; two conditions are spelt differently there.
_DUCKDB = {
    "TXN_014": f"txn_date >= DATE '{AS_OF}' - INTERVAL 24 MONTH",
    "TXN_020": "regexp_matches(customer_id, '^(CUST|C)[0-9]{3,10}$')",
}
_RULES = [
    (i, name, _DUCKDB.get(i, condition.format(as_of=f"DATE '{AS_OF}'")), severity, threshold)
    for i, name, _, condition, severity, threshold in dq.TRANSACTION_RULES
]
_GATE = " AND ".join(f"COALESCE({c}, FALSE)" for _, _, c, s, _ in _RULES if s == "ERROR")
_REASON = "CASE " + " ".join(
    f"WHEN NOT COALESCE({c}, FALSE) THEN '{i}:{n}'" for i, n, c, s, _ in _RULES if s == "ERROR"
) + " END"
_LINES = " UNION ALL ".join(
    f"SELECT '{i}' AS rule_id, '{n}' AS rule_name, '{s}' AS severity, CAST({t} AS DOUBLE) AS threshold, COUNT(*) AS total_records, "
    f"COUNT(*) FILTER (WHERE NOT COALESCE({c}, FALSE)) AS failed_records FROM dirty"
    for i, n, c, s, t in _RULES
)
RESULTS = f"""{DIRTY}, lines AS ({_LINES}), results AS (SELECT *, total_records - failed_records AS passed_records,
  ROUND(failed_records * 100.0 / total_records, 4) AS failure_pct,
  CASE WHEN failed_records * 100.0 / total_records <= threshold THEN 'PASSED' ELSE 'FAILED' END AS status FROM lines)"""


def rules():
    return dq.transaction_rules(AS_OF)


def checked(t: Tables):
    return dq.run_checks(t.dirty, rules(), "daily", AS_OF)


@query(
    "q01_single_rule",
    f"WITH {RESULTS} SELECT rule_id, failed_records, status FROM results WHERE rule_id = 'TXN_010'",
)
def q01(t: Tables):
    rule = dq.Rule("TXN_010", "amount_positive", "amount", "amount > 0")
    return dq.rule_results(t.dirty, [rule]).select("rule_id", "failed_records", "status")


@query("q02_passed_rows", f"WITH {DIRTY} SELECT txn_id, amount FROM dirty WHERE {_GATE}")
def q02(t: Tables):
    return checked(t).passed.select("txn_id", "amount")


@query("q03_failed_rows_with_reason", f"WITH {DIRTY} SELECT txn_id, {_REASON} AS reason, '{AS_OF}' AS batch FROM dirty WHERE NOT ({_GATE})")
def q03(t: Tables):
    failed = checked(t).failed
    return failed.select("txn_id", F.col("_dq_failure_reason").alias("reason"), F.col("_dq_batch_date").alias("batch"))


@query("q04_rule_results", f"WITH {RESULTS} SELECT * FROM results")
def q04(t: Tables):
    return checked(t).results


@query(
    "q04_failure_samples",
    f"WITH {DIRTY}, f AS ("
    + " UNION ALL ".join(
        f"SELECT '{i}' AS rule_id, txn_id, customer_id, payment_mode, amount FROM dirty WHERE NOT COALESCE({c}, FALSE)"
        for i, _, c, _, _ in _RULES
    )
    + """) SELECT rule_id, txn_id AS record_key, customer_id, payment_mode, amount FROM f
        QUALIFY ROW_NUMBER() OVER (PARTITION BY rule_id ORDER BY txn_id) <= 5""",
)
def q04b(t: Tables):
    """Samples of every standard rule; the record is compared by its fields."""
    samples = dq.sample_failures(t.dirty, rules(), "txn_id")
    field = lambda name: F.get_json_object("record", f"$.{name}")
    return samples.select(
        "rule_id",
        "record_key",
        field("customer_id").alias("customer_id"),
        field("payment_mode").alias("payment_mode"),
        field("amount").cast("double").alias("amount"),
    )


REPORT = """COUNT(*) AS total_rules, COUNT(*) FILTER (WHERE status = 'PASSED') AS passed_rules,
  COUNT(*) FILTER (WHERE status = 'FAILED' AND severity = 'ERROR') AS failed_errors, COUNT(*) FILTER (WHERE status = 'FAILED' AND severity = 'WARNING') AS failed_warnings,
  CASE WHEN COUNT(*) FILTER (WHERE status = 'FAILED' AND severity = 'ERROR') > 0 THEN 'FAILED' WHEN COUNT(*) FILTER (WHERE status = 'FAILED') > 0 THEN 'WARNING' ELSE 'PASSED' END AS overall_status"""


@query("q05_report", f"WITH {RESULTS} SELECT {REPORT} FROM results")
def q05(t: Tables):
    return dq.quality_report(checked(t).results)


@query("q06_standard_rule_set", f"WITH {RESULTS} SELECT rule_id, severity, passed_records FROM results")
def q06(t: Tables):
    return dq.rule_results(t.dirty, rules()).select("rule_id", "severity", "passed_records")


@query(
    "q07_volume_anomalies",
    """WITH d AS (SELECT ts::DATE AS day, COUNT(*) AS n FROM events GROUP BY 1),
       b AS (SELECT day, n, AVG(n) OVER (ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS baseline FROM d)
       SELECT CAST(day AS VARCHAR) AS day, n, ROUND(baseline, 4) AS baseline, ROUND(ABS(n - baseline) / baseline * 100, 4) AS deviation_pct,
         COALESCE(ABS(n - baseline) / baseline * 100 <= 5, TRUE) AS is_ok FROM b""",
)
def q07(t: Tables):
    daily = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    out = dq.volume_anomalies(daily, "day", "n", 7, 5.0)
    return out.withColumns({"day": F.col("day").cast("string"), "baseline": F.round("baseline", 4)})


@query(
    "q08_null_rate_limits",
    f"""WITH {DIRTY} SELECT UNNEST(['amount', 'customer_id', 'txn_id']) AS column_name,
        UNNEST([COUNT(*) - COUNT(amount) <= 0.5 * COUNT(*) / 100, COUNT(*) - COUNT(customer_id) <= 5.0 * COUNT(*) / 100, COUNT(*) = COUNT(txn_id)]) AS is_ok FROM dirty""",
)
def q08(t: Tables):
    report = aggregates.null_report(t.dirty, ["amount", "customer_id", "txn_id"])
    return dq.null_rate_limits(report, {"amount": 0.5, "txn_id": 0.0}).select("column_name", "is_ok")


@query(
    "q09_distribution_drift",
    "SELECT UNNEST(['p25', 'p50', 'p75', 'p95']) AS percentile, FALSE AS is_ok, TRUE AS drift_near_50 FROM (SELECT 1 FROM orders LIMIT 1)",
)
def q09(t: Tables):
    """Amounts half as large again drift by about 50 % at every percentile."""
    shifted = t.txn.withColumn("amount", F.col("amount") * 1.5)
    out = dq.distribution_drift(shifted, t.txn, "amount", 25.0)
    return out.select("percentile", "is_ok", F.col("drift_pct").between(49, 51).alias("drift_near_50"))


_MERGED = """SELECT FLOOR({amount} / 100) AS bin, COUNT(*) AS n FROM txn WHERE {which} GROUP BY 1"""
_POINTS = "(VALUES ('p25', 0.25), ('p50', 0.50), ('p75', 0.75), ('p95', 0.95)) AS p(percentile, share)"


@query(
    "q09_drift_from_stored_baseline",
    f"""WITH {TXN}, b AS ({_MERGED.format(amount="amount", which="txn_date < DATE '1997-01-01'")}), c AS ({_MERGED.format(amount="amount * 1.2", which="txn_date >= DATE '1997-01-01'")}),
        bu AS (SELECT bin, SUM(n) OVER (ORDER BY bin) AS upto, SUM(n) OVER () AS total FROM b), cu AS (SELECT bin, SUM(n) OVER (ORDER BY bin) AS upto, SUM(n) OVER () AS total FROM c),
        v AS (SELECT percentile, (SELECT MIN(bin) * 100.0 FROM cu WHERE upto >= share * total) AS current_value, (SELECT MIN(bin) * 100.0 FROM bu WHERE upto >= share * total) AS baseline_value FROM {_POINTS})
        SELECT percentile, CAST(current_value AS DOUBLE) AS current_value, CAST(baseline_value AS DOUBLE) AS baseline_value,
          ROUND(ABS(CAST(current_value AS DOUBLE) - CAST(baseline_value AS DOUBLE)) * 100 / ABS(CAST(baseline_value AS DOUBLE)), 4) AS drift_pct,
          ABS(current_value - baseline_value) * 100 / ABS(baseline_value) <= 15 AS is_ok FROM v""",
)
def q09b(t: Tables):
    """Each month stores its histogram, one of them twice; the baseline is merged from months."""
    path = workspace(t.spark, "histograms")
    dated = t.txn.withColumn("month", F.date_format("txn_date", "yyyy-MM"))
    before = dated.where("txn_date < DATE '1997-01-01'")
    after = dated.where("txn_date >= DATE '1997-01-01'").withColumn("amount", F.col("amount") * 1.2)
    for name, rows in (("baseline", before), ("baseline", before.where("month = '1996-03'")), ("current", after)):
        dq.store_histograms(rows, f"{path}/{name}", "month", "amount", 100.0)
    return dq.stored_drift(t.spark.read.parquet(f"{path}/current"), t.spark.read.parquet(f"{path}/baseline"), 15.0)


@query(
    "q10_referential_integrity",
    """SELECT CAST(COUNT(*) AS BIGINT) AS orphan_rows, COUNT(DISTINCT o_custkey) AS orphan_keys FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 3)""",
)
def q10(t: Tables):
    parents = t.customer.where("c_custkey % 10 <> 3")
    return dq.orphan_count(t.orders, parents, "o_custkey", "c_custkey")


def yearly_results(t: Tables):
    """Rule results of one run per year of transactions, from one pass over all years."""
    dated = t.dirty.withColumn("batch_date", F.concat(F.year("txn_date").cast("string"), F.lit("-12-31")))
    return dq.rule_results(dated, rules(), ["batch_date"])


_YEARLY = " UNION ALL ".join(
    f"SELECT CAST(YEAR(txn_date) AS VARCHAR) || '-12-31' AS batch_date, '{i}' AS rule_id, '{n}' AS rule_name, '{s}' AS severity, COUNT(*) FILTER (WHERE NOT COALESCE({c}, FALSE)) AS failed_records, "
    f"CASE WHEN COUNT(*) FILTER (WHERE NOT COALESCE({c}, FALSE)) * 100.0 / COUNT(*) <= {t} THEN 'PASSED' ELSE 'FAILED' END AS status FROM dirty GROUP BY 1"
    for i, n, c, s, t in _RULES
)


@query(
    "q11_pass_rate_trend",
    f"""WITH {DIRTY}, r AS ({_YEARLY}), b AS (SELECT batch_date, {REPORT} FROM r GROUP BY batch_date)
        SELECT batch_date, overall_status, total_rules, passed_rules, failed_errors, ROUND(passed_rules * 100.0 / total_rules, 1) AS pass_rate_pct FROM b""",
)
def q11(t: Tables):
    return dq.pass_rate_trend(dq.quality_report(yearly_results(t), ["batch_date"]))


@query(
    "q11_failing_rules",
    f"""WITH {DIRTY}, r AS ({_YEARLY}) SELECT rule_id, rule_name, COUNT(*) AS failure_count, ROUND(AVG(failed_records), 2) AS avg_failures FROM r WHERE status = 'FAILED' GROUP BY 1, 2""",
)
def q11b(t: Tables):
    return dq.failing_rules(yearly_results(t))


@query(
    "q11_quarantine_summary",
    f"""WITH {DIRTY} SELECT {_REASON} AS _dq_failure_reason, '{AS_OF}' AS _dq_batch_date, COUNT(*) AS record_count, ROUND(SUM(amount), 2) AS total_bad_amount FROM dirty WHERE NOT ({_GATE}) GROUP BY 1""",
)
def q11c(t: Tables):
    return dq.quarantine_summary(checked(t).failed, "amount")


EXPECTATIONS = {"positive": "amount > 0", "has_customer": "customer_id IS NOT NULL"}


@query("q12_expect_warn", f"WITH {DIRTY} SELECT COUNT(*) AS n FROM dirty")
def q12(t: Tables):
    watched, _ = dq.expect(t.dirty, EXPECTATIONS, "warn", "warned")
    return watched.agg(F.count(F.lit(1)).alias("n"))


@query("q12_expect_drop", f"WITH {DIRTY} SELECT txn_id FROM dirty WHERE amount > 0 AND customer_id IS NOT NULL")
def q12b(t: Tables):
    kept, _ = dq.expect(t.dirty, EXPECTATIONS, "drop", "dropped")
    return kept.select("txn_id")


@query("q12_expect_fail_on_clean_data", f"WITH {TXN} SELECT COUNT(*) AS n FROM txn")
def q12c(t: Tables):
    passed, _ = dq.expect(t.txn, EXPECTATIONS, "fail", "failing")
    return passed.agg(F.count(F.lit(1)).alias("n"))


@query(
    "q12_expectation_rows",
    f"""WITH {DIRTY}, b AS (SELECT CAST(YEAR(txn_date) AS BIGINT) AS batch_id, COUNT(*) AS rows, COUNT(*) FILTER (WHERE NOT COALESCE(amount > 0, FALSE)) AS p, COUNT(*) - COUNT(customer_id) AS h FROM dirty GROUP BY 1)
        SELECT batch_id, UNNEST(['positive', 'has_customer']) AS expectation, 'drop' AS action, rows, UNNEST([p, h]) AS failed, UNNEST([p = 0, h = 0]) AS passed FROM b""",
)
def q12e(t: Tables):
    """One batch per year; its rows come from the pass that writes it."""
    out = workspace(t.spark, "expected")
    for year in range(1992, 2002):
        batch = t.dirty.where(F.year("txn_date") == year)
        dq.write_expected(batch, f"{out}/data", f"{out}/log", EXPECTATIONS, "drop", year)
    found = dq.expectation_results(t.spark, f"{out}/log")
    return found.where("rows > 0").select("batch_id", "expectation", "action", "rows", "failed", "passed")


@query("q12_expect_unique", "SELECT COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS surplus_rows, FALSE AS passed FROM lineitem")
def q12d(t: Tables):
    return dq.expect_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "q13_column_tests",
    f"""WITH {DIRTY}, f AS (SELECT COUNT(*) FILTER (WHERE customer_id IS NULL) AS a, COUNT(*) FILTER (WHERE payment_mode NOT IN ('CARD', 'UPI', 'NETBANKING', 'NEFT', 'WALLET')) AS b,
        COUNT(*) FILTER (WHERE amount IS NULL OR amount < 0) AS c FROM dirty)
        SELECT UNNEST(['not_null', 'accepted_values', 'accepted_range']) AS rule_name, UNNEST([a, b, c]) AS failed_records FROM f""",
)
def q13(t: Tables):
    tests = [
        dq.not_null("customer_id"),
        dq.accepted_values("payment_mode", ["CARD", "UPI", "NETBANKING", "NEFT", "WALLET"]),
        dq.accepted_range("amount", low=0),
    ]
    return dq.rule_results(t.dirty, tests).select("rule_name", "failed_records")


@query(
    "q13_recency",
    f"WITH {TXN} SELECT CAST(MAX(txn_date) AS VARCHAR) AS newest, CAST(DATE '2001-08-03' - MAX(txn_date) AS INT) AS lag_days, DATE '2001-08-03' - MAX(txn_date) <= 2 AS passed FROM txn",
)
def q13b(t: Tables):
    out = dq.recency(t.txn, "txn_date", F.lit("2001-08-03").cast("date"), 2)
    return out.withColumn("newest", F.col("newest").cast("string"))


def letters(t: Tables):
    failed = checked(t).failed
    return dq.dead_letters(failed, "daily", AS_OF, F.col("_dq_failure_reason"), F.lit("2001-08-02").cast("timestamp"))


@query(
    "q14_dead_letters",
    f"""WITH {DIRTY} SELECT txn_id, {_REASON} AS failure_reason, 0 AS retry_count, FALSE AS resolved FROM dirty WHERE NOT ({_GATE})""",
)
def q14(t: Tables):
    out = letters(t)
    return out.select(
        F.get_json_object("original_data", "$.txn_id").cast("bigint").alias("txn_id"), "failure_reason", "retry_count", "resolved"
    )


@query(
    "q15_resolve_dead_letters",
    f"""WITH {DIRTY} SELECT {_REASON} LIKE 'TXN_012%' AS resolved, COUNT(*) AS n FROM dirty WHERE NOT ({_GATE}) GROUP BY 1""",
)
def q15(t: Tables):
    fixed = letters(t).where(F.col("failure_reason").startswith("TXN_012")).select("record_id")
    return dq.mark_resolved(letters(t), fixed).groupBy("resolved").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q16_rejection_gate",
    f"""WITH {DIRTY}, b AS (SELECT CAST(YEAR(txn_date) AS INT) AS y, COUNT(*) AS total, COUNT(*) FILTER (WHERE NOT ({_GATE})) AS rejected FROM dirty GROUP BY 1)
        SELECT y, total, rejected, CASE WHEN rejected * 100.0 / total > 50 THEN 'FAILED' WHEN rejected * 100.0 / total > 5 THEN 'WARNING' ELSE 'OK' END AS gate FROM b""",
)
def q16(t: Tables):
    bad = F.lit(False)
    for r in rules():
        if r.severity == "ERROR":
            bad = bad | ~r.holds
    batches = t.dirty.groupBy(F.year("txn_date").alias("y")).agg(
        F.count(F.lit(1)).alias("total"), F.count(F.when(bad, F.lit(1))).alias("rejected")
    )
    return dq.enforce_gate(batches.withColumn("gate", dq.rejection_gate(F.col("total"), F.col("rejected"))))


@query(
    "q17_clean_transactions",
    f"""WITH {DIRTY} SELECT txn_id, customer_id, amount FROM dirty WHERE customer_id IS NOT NULL AND amount > 0 AND payment_mode IN ('CARD','UPI','NETBANKING','NEFT','RTGS','IMPS','WALLET')""",
)
def q17(t: Tables):
    return dq.clean_transactions(t.dirty, MODES).select("txn_id", "customer_id", "amount")


@query(
    "q18_duplicate_statistics",
    """WITH c AS (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
       SELECT CAST(SUM(n) AS BIGINT) AS total_rows, COUNT(*) AS distinct_keys, CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicate_rows, COUNT(*) FILTER (WHERE n > 1) AS duplicated_keys FROM c""",
)
def q18(t: Tables):
    return aggregates.duplicate_stats(t.lineitem, ["l_orderkey", "l_linenumber"])
