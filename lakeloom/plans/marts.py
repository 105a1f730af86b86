"""Marts, segments, dashboards and operational reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.incremental import Load, incremental_load
from lakeloom.operators.ordered import top_n
from lakeloom.operators.quality import Checked, Rule, run_checks

# Least spend and transaction count of each segment, best first.
SEGMENTS = (("CHAMPION", 50_000, 10), ("LOYAL", 20_000, 5), ("POTENTIAL", 5_000, 0))


def segment(spend: Column, count: Column, scale: float = 1.0) -> Column:
    out = F.when(F.lit(False), F.lit(None))
    for label, least_spend, least_count in SEGMENTS:
        out = out.when((spend >= least_spend * scale) & (count >= least_count), label)
    return out.when(spend > 0, "AT_RISK").otherwise("INACTIVE")


def recent_activity_rows(txns: DataFrame, rows: int = 30) -> DataFrame:
    """Spend and count over the newest ``rows`` transactions of each customer.

    Taking the top rows first lets Spark cut every customer down before the shuffle.
    """
    newest = top_n(txns, ["customer_id"], [F.col("txn_date").desc(), F.col("txn_id").desc()], rows)
    return newest.groupBy("customer_id").agg(
        F.sum("amount").alias("recent_spend"), F.count(F.lit(1)).alias("recent_txns")
    )


def recent_activity_days(txns: DataFrame, days: int = 30) -> DataFrame:
    """Spend and count in the ``days`` calendar days up to each customer's newest date.

    Daily sums come first, so a busy customer is a handful of rows before the join.
    """
    daily = txns.groupBy("customer_id", "txn_date").agg(
        F.sum("amount").alias("spend"), F.count(F.lit(1)).alias("n")
    )
    last = daily.groupBy("customer_id").agg(F.max("txn_date").alias("last_date"))
    inside = F.col("txn_date") > F.date_sub("last_date", days)
    return (
        daily.join(last, "customer_id")
        .where(inside)
        .groupBy("customer_id")
        .agg(F.sum("spend").alias("recent_spend"), F.sum("n").alias("recent_txns"))
    )



def executive_dashboard(scored: DataFrame, customers: DataFrame) -> DataFrame:
    """Daily figures by payment mode, city and tier with previous-day and month totals.

    City and tier join at transaction grain; the windows run over the daily rows.
    """
    dims = customers.select("customer_id", "city", "tier")
    daily = (
        scored.join(dims, "customer_id", "left")
        .groupBy("txn_date", "payment_mode", "city", "tier")
        .agg(
            F.count("txn_id").alias("transactions"),
            F.sum("amount").alias("revenue"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.count(F.when(F.col("fraud_risk_level") == "HIGH", F.lit(1))).alias("fraud_alerts"),
        )
    )
    line = Window.partitionBy("payment_mode", "city", "tier").orderBy("txn_date")
    month = Window.partitionBy("payment_mode", "city", "tier", F.trunc("txn_date", "month"))
    return daily.select(
        "txn_date",
        F.year("txn_date").alias("year"),
        F.month("txn_date").alias("month"),
        F.date_format("txn_date", "MMMM").alias("month_name"),
        F.quarter("txn_date").alias("quarter"),
        "payment_mode",
        "city",
        "tier",
        "transactions",
        F.round("revenue", 2).alias("revenue"),
        F.round(F.col("revenue") / F.col("transactions"), 4).alias("avg_transaction_value"),
        "unique_customers",
        "fraud_alerts",
        F.round(F.try_divide(F.col("fraud_alerts") * 100.0, "transactions"), 2).alias("fraud_rate_pct"),
        F.round(F.lag("revenue").over(line), 2).alias("previous_revenue"),
        F.round(F.sum("revenue").over(month), 2).alias("monthly_revenue"),
    )


def sales_mart(scored: DataFrame) -> DataFrame:
    return (
        scored.where(F.col("payment_mode").isin("CARD", "UPI"))
        .groupBy("txn_date", "merchant_id")
        .agg(F.round(F.sum("amount"), 2).alias("total_sales"), F.count("txn_id").alias("transaction_count"))
    )


def fraud_mart(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("fraud_risk_level") != "NORMAL").select(
        "txn_id", "txn_date", "customer_id", "amount", "fraud_risk_level", "fraud_score"
    )


def finance_mart(scored: DataFrame) -> DataFrame:
    return (
        scored.where(F.col("status") == "COMPLETED")
        .groupBy("txn_date", "currency")
        .agg(
            F.round(F.sum("amount"), 2).alias("settled_amount"),
            F.count("txn_id").alias("settled_count"),
            F.round(F.avg("amount"), 4).alias("avg_settlement"),
        )
    )


def fan_out(source: DataFrame, targets: Mapping[str, tuple[Callable[[DataFrame], DataFrame], str]]) -> None:
    """Write several marts from one source that is computed once.

    ``targets`` maps a name to ``(build, path)``. The source spills to disk when memory is
    short and is released afterwards.
    """
    from lakeloom.operators.layout import cached

    with cached(source) as shared:
        for build, path in targets.values():
            build(shared).write.mode("overwrite").parquet(path)


@dataclass(frozen=True)
class Entity:
    """Settings of one entity in a configuration-driven pipeline."""

    keys: tuple[str, ...]
    watermark_column: str
    rules: tuple[Rule, ...] = ()
    tie: tuple[str, ...] = ()


def run_entity(
    name: str, entity: Entity, source: DataFrame, target: DataFrame, watermark=None, batch: str = ""
) -> tuple[Checked, Load]:
    """Check an entity's source, then load the rows that passed into its target."""
    checked = run_checks(source, entity.rules, name, batch)
    load = incremental_load(
        checked.passed, target, entity.keys, entity.watermark_column, watermark, entity.tie
    )
    return checked, load


def run_trend(log: DataFrame) -> DataFrame:
    """Duration and success rate per batch of a run log (``batch_date, total_duration, status``)."""
    ok = F.count(F.when(F.col("status") == "SUCCESS", F.lit(1)))
    failed = F.count(F.when(F.col("status") == "FAILED", F.lit(1)))
    return (
        log.groupBy("batch_date")
        .agg(
            F.round(F.avg("total_duration"), 4).alias("avg_duration_seconds"),
            F.max("total_duration").alias("max_duration_seconds"),
            F.count(F.lit(1)).alias("run_count"),
            ok.alias("success_count"),
            failed.alias("failure_count"),
        )
        .withColumn(
            "success_rate_pct", F.round(F.col("success_count") / F.col("run_count") * 100, 4)
        )
    )


def sla_breaches(log: DataFrame, limit_seconds: float = 7200) -> DataFrame:
    return log.where(F.col("total_duration") > limit_seconds)


def usage_cost(usage: DataFrame, runs: DataFrame, price: float = 0.40) -> DataFrame:
    """Consumption and cost per job and day, joined to the run time line by ``run_id``."""
    return (
        usage.join(runs, "run_id")
        .groupBy("run_name", "run_date")
        .agg(
            F.round(F.sum("usage_quantity"), 4).alias("units"),
            F.round(F.sum(F.col("usage_quantity") * price), 4).alias("estimated_cost"),
            F.round(F.avg("runtime_minutes"), 4).alias("avg_runtime_min"),
        )
    )


def sensor_alerts(readings: DataFrame) -> DataFrame:
    """Anomaly flags and alert level per reading; works on batches and streams."""
    return readings.withColumns(
        {
            "is_speed_anomaly": F.coalesce(F.col("speed_kmh") > 120, F.lit(False)),
            "is_temp_anomaly": F.coalesce(F.col("temperature_c") > 45, F.lit(False)),
            "is_fuel_critical": F.coalesce(F.col("fuel_level_pct") < 10, F.lit(False)),
            "is_engine_issue": F.coalesce(F.col("engine_status") != "RUNNING", F.lit(False)),
        }
    ).withColumn(
        "alert_level",
        F.when(F.col("is_speed_anomaly") | F.col("is_engine_issue"), "CRITICAL")
        .when(F.col("is_temp_anomaly") | F.col("is_fuel_critical"), "WARNING")
        .otherwise("NORMAL"),
    )


def group_summary(people: DataFrame, group: str, salary: str) -> DataFrame:
    """Headcount and pay per group."""
    return people.groupBy(group).agg(
        F.count(F.lit(1)).alias("headcount"),
        F.round(F.avg(salary), 4).alias("avg_salary"),
        F.max(salary).alias("max_salary"),
    )
