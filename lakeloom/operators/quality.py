"""Data-quality rules, expectations, quarantine and dead letters.

A condition that evaluates to NULL fails: a row is either passed or failed, never lost.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.operators.merge import Update, merge, replace_partitions
from lakeloom.operators.ordered import running_total, top_n


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    column: str
    condition: str
    severity: str = "ERROR"
    threshold: float = 0.0

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


@dataclass(frozen=True)
class Checked:
    """``passed`` and ``failed`` partition the input; ``results`` has one row per rule."""

    passed: DataFrame
    failed: DataFrame
    results: DataFrame


# The standard rules for transactions. {as_of} is the run date.
TRANSACTION_RULES = (
    ("TXN_001", "transaction_id_not_null", "txn_id", "txn_id IS NOT NULL", "ERROR", 0.0),
    ("TXN_002", "amount_not_null", "amount", "amount IS NOT NULL", "ERROR", 0.0),
    ("TXN_003", "customer_id_not_null", "customer_id", "customer_id IS NOT NULL", "ERROR", 0.5),
    ("TXN_010", "amount_positive", "amount", "amount > 0", "ERROR", 0.0),
    ("TXN_011", "amount_reasonable", "amount", "amount < 100000000", "WARNING", 0.1),
    (
        "TXN_012",
        "payment_mode_valid",
        "payment_mode",
        "payment_mode IN ('CARD','UPI','NETBANKING','NEFT','RTGS','IMPS','WALLET','CASH')",
        "ERROR",
        1.0,
    ),
    ("TXN_013", "date_not_future", "txn_date", "txn_date <= {as_of}", "ERROR", 0.0),
    ("TXN_014", "date_not_too_old", "txn_date", "txn_date >= add_months({as_of}, -24)", "WARNING", 5.0),
    ("TXN_020", "customer_id_format", "customer_id", "customer_id RLIKE '^(CUST|C)[0-9]{{3,10}}$'", "ERROR", 2.0),
    (
        "TXN_030",
        "card_txn_has_merchant",
        "merchant_id",
        "NOT (payment_mode = 'CARD' AND merchant_id IS NULL)",
        "WARNING",
        5.0,
    ),
    (
        "TXN_031",
        "status_transition_valid",
        "status",
        "NOT (status = 'CANCELLED' AND amount > 0)",
        "WARNING",
        0.0,
    ),
)


def transaction_rules(as_of: str) -> list[Rule]:
    """The standard rules with the run date filled in (``YYYY-MM-DD``)."""
    day = f"DATE'{as_of}'"
    return [Rule(i, n, c, sql.format(as_of=day), s, t) for i, n, c, sql, s, t in TRANSACTION_RULES]


# Rule constructors for the usual column tests.


def not_null(column: str, **more) -> Rule:
    return Rule(f"not_null_{column}", "not_null", column, f"{column} IS NOT NULL", **more)


def accepted_values(column: str, values: Sequence[str], **more) -> Rule:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return Rule(f"accepted_values_{column}", "accepted_values", column, f"{column} IN ({listed})", **more)


def accepted_range(column: str, low: float | None = None, high: float | None = None, **more) -> Rule:
    parts = [f"{column} >= {low}"] if low is not None else []
    parts += [f"{column} <= {high}"] if high is not None else []
    return Rule(f"accepted_range_{column}", "accepted_range", column, " AND ".join(parts), **more)


def recency(df: DataFrame, column: str, as_of: Column, days: int) -> DataFrame:
    """Whether the newest date is within ``days`` of ``as_of``."""
    newest = F.max(F.to_date(column))
    lag = F.datediff(as_of, newest)
    return df.agg(
        newest.alias("newest"),
        lag.alias("lag_days"),
        F.coalesce(lag <= days, F.lit(False)).alias("passed"),
    )


def rule_results(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """Counts, percentage and verdict per rule (and per ``by``), in a single pass."""
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count(F.when(~r.holds, F.lit(1))).alias(f"_f{i}") for i, r in enumerate(rules)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(r.rule_id).alias("rule_id"),
                F.lit(r.name).alias("rule_name"),
                F.lit(r.severity).alias("severity"),
                F.lit(float(r.threshold)).alias("threshold"),
                F.col(f"_f{i}").alias("failed_records"),
            )
            for i, r in enumerate(rules)
        ]
    )
    pct = F.coalesce(F.try_divide(F.col("failed_records") * 100.0, "total_records"), F.lit(0.0))
    return (
        counted.select(*by, "total_records", F.inline(lines))
        .withColumn("passed_records", F.col("total_records") - F.col("failed_records"))
        .withColumn("failure_pct", F.round(pct, 4))
        .withColumn("status", F.when(pct <= F.col("threshold"), "PASSED").otherwise("FAILED"))
    )


def run_checks(df: DataFrame, rules: Sequence[Rule], pipeline: str = "", batch: str = "") -> Checked:
    """Split rows by the ERROR rules and summarise all rules.

    A threshold decides the verdict of a rule, not the fate of a row: rows failing an ERROR
    rule go to ``failed`` even when that rule as a whole is within its threshold.
    """
    gates = [r for r in rules if r.severity == "ERROR"]
    labels = [F.when(~r.holds, F.lit(f"{r.rule_id}:{r.name}")) for r in gates]
    reasons = F.array_compact(F.array(*labels)) if labels else F.array().cast("array<string>")
    marked = df.withColumn("_dq_reasons", reasons)
    passed = marked.where(F.size("_dq_reasons") == 0).drop("_dq_reasons")
    failed = (
        marked.where(F.size("_dq_reasons") > 0)
        .withColumn("_dq_failure_reason", F.col("_dq_reasons")[0])
        .withColumn("_dq_pipeline", F.lit(pipeline))
        .withColumn("_dq_batch_date", F.lit(batch))
    )
    return Checked(passed, failed, rule_results(df, rules))


def sample_failures(df: DataFrame, rules: Sequence[Rule], key: str, n: int = 5) -> DataFrame:
    """Up to ``n`` failing rows per rule as JSON, the smallest keys first."""
    hits = F.array_compact(F.array(*[F.when(~r.holds, F.lit(r.rule_id)) for r in rules]))
    exploded = df.select(
        F.explode(hits).alias("rule_id"),
        F.col(key).alias("record_key"),
        F.to_json(F.struct(*df.columns)).alias("record"),
    )
    return top_n(exploded, ["rule_id"], [F.col("record_key").asc_nulls_last(), F.col("record")], n)


def quality_report(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """PASSED, WARNING or FAILED overall, one row (or one per ``by``)."""
    failed = F.col("status") == "FAILED"
    errors = F.count(F.when(failed & (F.col("severity") == "ERROR"), F.lit(1)))
    warnings = F.count(F.when(failed & (F.col("severity") == "WARNING"), F.lit(1)))
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rules"),
        F.count(F.when(~failed, F.lit(1))).alias("passed_rules"),
        errors.alias("failed_errors"),
        warnings.alias("failed_warnings"),
    ).withColumn(
        "overall_status",
        F.when(F.col("failed_errors") > 0, "FAILED")
        .when(F.col("failed_warnings") > 0, "WARNING")
        .otherwise("PASSED"),
    )


def pass_rate_trend(runs: DataFrame) -> DataFrame:
    """Pass rate per batch over reports that carry ``batch_date``."""
    return runs.select(
        "batch_date",
        "overall_status",
        "total_rules",
        "passed_rules",
        "failed_errors",
        F.round(F.col("passed_rules") * 100.0 / F.col("total_rules"), 1).alias("pass_rate_pct"),
    )


def failing_rules(results: DataFrame) -> DataFrame:
    """How often each rule failed over many runs, and its average failing rows."""
    return (
        results.where(F.col("status") == "FAILED")
        .groupBy("rule_id", "rule_name")
        .agg(
            F.count(F.lit(1)).alias("failure_count"),
            F.round(F.avg("failed_records"), 2).alias("avg_failures"),
        )
    )


def quarantine_summary(failed: DataFrame, amount: str) -> DataFrame:
    return failed.groupBy("_dq_failure_reason", "_dq_batch_date").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.round(F.sum(F.expr(f"try_cast({amount} AS DOUBLE)")), 2).alias("total_bad_amount"),
    )


def volume_anomalies(
    daily: DataFrame, day: str, count: str, lookback_days: int = 7, tolerance_pct: float = 30.0
) -> DataFrame:
    """Each day's volume against the mean of the ``lookback_days`` before it.

    ``daily`` has one row per day. A day without history passes.
    """
    w = Window.orderBy("_day").rangeBetween(-lookback_days, -1)
    mean = F.avg(count).over(w)
    deviation = F.abs(F.col(count) - F.col("baseline")) / F.col("baseline") * 100
    return (
        daily.withColumn("_day", F.unix_date(day))
        .withColumn("baseline", mean)
        .drop("_day")
        .withColumn("deviation_pct", F.round(deviation, 4))
        .withColumn("is_ok", F.coalesce(deviation <= tolerance_pct, F.lit(True)))
    )


# The percentiles to compare.
DRIFT_POINTS = {"p25": 0.25, "p50": 0.50, "p75": 0.75, "p95": 0.95}


def _with_drift(both: DataFrame, tolerance_pct: float) -> DataFrame:
    drift = F.abs(F.col("current_value") - F.col("baseline_value")) * 100 / F.abs("baseline_value")
    return both.withColumn("drift_pct", F.round(drift, 4)).withColumn(
        "is_ok", F.coalesce(drift <= tolerance_pct, F.lit(True))
    )


def distribution_drift(
    current: DataFrame, baseline: DataFrame, amount: str, tolerance_pct: float = 25.0
) -> DataFrame:
    """Percentiles of two frames side by side with their relative drift."""

    def measured(df: DataFrame, value: str) -> DataFrame:
        row = df.agg(*[F.percentile_approx(amount, p, 10_000).alias(n) for n, p in DRIFT_POINTS.items()])
        return row.unpivot([], list(DRIFT_POINTS), "percentile", value)

    return _with_drift(measured(current, "current_value").join(measured(baseline, "baseline_value"), "percentile"), tolerance_pct)


def store_histograms(df: DataFrame, path: str, period: str, value: str, resolution: float = 1.0) -> None:
    """Write how often each value occurs per ``period``, values cut to multiples of ``resolution``.

    Histograms add up, so any choice of stored periods is a baseline. A period that is
    stored again replaces its histogram.
    """
    step = F.lit(float(resolution))
    bins = df.where(F.col(value).isNotNull()).select(F.col(period).alias("period"), F.floor(F.col(value) / step).alias("bin"))
    counted = bins.groupBy("period", "bin").agg(F.count(F.lit(1)).alias("n"), F.lit(float(resolution)).alias("resolution"))
    replace_partitions(counted, path, "period")


def stored_percentiles(histograms: DataFrame, points: Mapping[str, float], block: int = 1024) -> DataFrame:
    """``percentile, value`` of merged histograms: the smallest value whose share reaches the point.

    Bins are summed up in blocks, with one row per block carried over, never in one task.
    """
    merged = histograms.groupBy("bin", "resolution").agg(F.sum("n").alias("n"))
    merged = merged.withColumns({"all": F.lit(0), "block": F.floor(F.col("bin") / block)})
    upto = running_total(merged, ["all"], [F.col("bin")], "n", "upto", F.col("block"))
    total = merged.agg(F.sum("n").alias("total"))
    named = F.explode(F.create_map(*[F.lit(x) for pair in points.items() for x in pair])).alias("percentile", "share")
    reached = upto.join(F.broadcast(total)).select("bin", "resolution", "upto", "total", named)
    first = reached.where(F.col("upto") >= F.col("share") * F.col("total")).groupBy("percentile").agg(
        F.min_by(F.col("bin") * F.col("resolution"), "bin").alias("value")
    )
    return first


def stored_drift(current: DataFrame, baseline: DataFrame, tolerance_pct: float = 25.0) -> DataFrame:
    """Percentiles of two sets of stored histograms and their relative drift."""
    now = stored_percentiles(current, DRIFT_POINTS).withColumnRenamed("value", "current_value")
    then = stored_percentiles(baseline, DRIFT_POINTS).withColumnRenamed("value", "baseline_value")
    return _with_drift(now.join(then, "percentile"), tolerance_pct)


def null_rate_limits(report: DataFrame, limits: Mapping[str, float], default: float = 5.0) -> DataFrame:
    """Verdict per column of :func:`lakeloom.operators.aggregates.null_report`."""
    limit = F.lit(default)
    for column, pct in limits.items():
        limit = F.when(F.col("column_name") == column, F.lit(pct)).otherwise(limit)
    return report.withColumn("limit_pct", limit).withColumn(
        "is_ok", F.col("null_count") * 100.0 <= F.col("limit_pct") * F.col("total_rows")
    )


def orphan_count(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Referential integrity: rows and distinct keys without a parent; NULL keys are exempt."""
    keys = child.where(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("n"))
    orphans = keys.join(parent, keys[child_key] == parent[parent_key], "left_anti")
    return orphans.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
        F.count(F.lit(1)).alias("orphan_keys"),
    )


def expect(
    df: DataFrame, expectations: Mapping[str, str], action: str = "warn", name: str = "expectations"
) -> tuple[DataFrame, Observation]:
    """Expectations that warn, drop or fail, with failure counts observed on the way.

    The counts cost no extra pass; read ``observation.get`` after an action on the frame.
    """
    holds = {n: F.coalesce(F.expr(sql), F.lit(False)) for n, sql in expectations.items()}
    observation = Observation(name)
    watched = df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.when(~ok, F.lit(1))).alias(n) for n, ok in holds.items()],
    )
    if action == "warn":
        return watched, observation
    everything = F.lit(True)
    for ok in holds.values():
        everything = everything & ok
    if action == "drop":
        return watched.where(everything), observation
    if action == "fail":
        stop = F.raise_error(F.lit(f"expectation failed: {', '.join(holds)}")).cast("boolean")
        return watched.where(F.when(everything, F.lit(True)).otherwise(stop)), observation
    raise ValueError(f"unknown action {action!r}")


def write_expected(
    df: DataFrame, path: str, log: str, expectations: Mapping[str, str], action: str, batch_id: int
) -> None:
    """Write a batch under its expectations, and one row per expectation to ``log``.

    The counts are observed by the job that writes; nothing is read a second time. Batch and
    log lie in folders of the batch and are overwritten when it is replayed. A batch that
    ``fail`` stops leaves neither.
    """
    watched, observation = expect(df, expectations, action, f"expectations-{batch_id}")
    watched.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    counts = observation.get
    lines = [(name, action, counts["rows"], counts[name]) for name in expectations]
    rows = df.sparkSession.createDataFrame(lines, "expectation string, action string, rows bigint, failed bigint")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")


def expectation_handler(path: str, log: str, expectations: Mapping[str, str], action: str = "warn"):
    """:func:`write_expected` as the handler of a stream's micro-batches."""

    def handle(df: DataFrame, batch_id: int) -> None:
        write_expected(df, path, log, expectations, action, batch_id)

    return handle


def expectation_results(spark: SparkSession, log: str) -> DataFrame:
    """``batch_id, expectation, action, rows, failed, passed`` of all logged batches."""
    rows = spark.read.schema("expectation string, action string, rows bigint, failed bigint, batch_id bigint").parquet(log)
    return rows.withColumn("passed", F.col("failed") == 0)


def expect_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: does every key occur once?"""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    surplus = F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))
    return counts.agg(surplus.alias("surplus_rows"), (surplus == 0).alias("passed"))


def dead_letters(
    failed: DataFrame, pipeline: str, batch: str, reason: Column, failed_at: Column, error: str = ""
) -> DataFrame:
    """Rows as JSON with everything needed to retry them.

    ``record_id`` hashes pipeline, batch and content, so a replay yields the same ids.
    """
    columns = [c for c in failed.columns if not c.startswith("_dq_")]
    out = failed.select(
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(batch).alias("batch_date"),
        reason.alias("failure_reason"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("original_data"),
        F.lit(error).alias("error_message"),
        failed_at.cast("timestamp").alias("failed_at"),
        F.lit(0).alias("retry_count"),
        F.lit(False).alias("resolved"),
    )
    identity = F.sha2(F.concat_ws("|", "pipeline_name", "batch_date", "original_data"), 256)
    return out.withColumn("record_id", identity)


def mark_resolved(letters: DataFrame, record_ids: DataFrame) -> DataFrame:
    """Set ``resolved`` for the given ids; asking twice changes nothing."""
    ids = record_ids.select("record_id").distinct()
    return merge(letters, ids, ["record_id"], [Update(set={"resolved": "true"})])


def unresolved(letters: DataFrame, batch: str | None = None) -> DataFrame:
    out = letters.where(~F.col("resolved"))
    return out if batch is None else out.where(F.col("batch_date") == batch)


def rejection_gate(
    total: Column, rejected: Column, warn_pct: float = 5.0, fail_pct: float = 50.0
) -> Column:
    """OK, WARNING above ``warn_pct`` rejected, FAILED above ``fail_pct``."""
    rate = F.coalesce(F.try_divide(rejected * 100.0, total), F.lit(0.0))
    return F.when(rate > fail_pct, "FAILED").when(rate > warn_pct, "WARNING").otherwise("OK")


def enforce_gate(status: DataFrame) -> DataFrame:
    """Pass a frame with a ``gate`` column through, failing the query on FAILED."""
    stop = F.raise_error(F.lit("rejection rate above the limit")).cast("boolean")
    return status.where(F.when(F.col("gate") == "FAILED", stop).otherwise(F.lit(True)))


def clean_transactions(df: DataFrame, modes: Sequence[str]) -> DataFrame:
    """Rows with id, customer, a positive amount and a known payment mode."""
    return df.where(
        F.col("txn_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & (F.col("amount") > 0)
        & F.col("payment_mode").isin(*modes)
    )
