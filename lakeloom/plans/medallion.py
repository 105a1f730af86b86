"""Bronze, silver and gold steps for transactions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.cleaning import code, to_date, to_money
from lakeloom.operators.merge import Insert, Update, merge, replace_partitions
from lakeloom.operators.ordered import latest_per_key

# Validation rules in the order their reasons are reported.
SILVER_RULES = {
    "NULL_TXN_ID": "txn_id IS NOT NULL",
    "INVALID_AMOUNT": "amount > 0",
    "AMOUNT_TOO_HIGH": "amount < 10000000",
    "INVALID_CUSTOMER_ID": "customer_id RLIKE '^(CUST|C)[0-9]+$'",
    "INVALID_DATE": "txn_date IS NOT NULL",
    "UNKNOWN_PAYMENT_MODE": (
        "payment_mode IN ('CARD','UPI','NETBANKING','NEFT','RTGS','IMPS','WALLET')"
    ),
    "UNKNOWN_CURRENCY": "currency IN ('INR','USD','EUR','GBP')",
}


def typed_transactions(bronze: DataFrame) -> DataFrame:
    """Bronze text columns as typed, standardised columns. Bad values become NULL."""
    when = F.concat_ws(" ", "txn_date", "txn_time")
    return bronze.withColumns(
        {
            "txn_id": F.col("txn_id").try_cast("bigint"),
            "txn_ts": F.try_to_timestamp(when, F.lit("yyyy-MM-dd HH:mm:ss")),
            "txn_date": to_date(F.col("txn_date")),
            "amount": to_money(F.col("amount")),
            "customer_id": code(F.col("customer_id")),
            "payment_mode": code(F.col("payment_mode")),
            "status": code(F.col("status")),
            "currency": code(F.col("currency")),
        }
    ).drop("txn_time")


def reject_reason(rules: Mapping[str, str] = SILVER_RULES) -> Column:
    """The first broken rule, NULL for a valid row."""
    out = F.lit(None).cast("string")
    for label, sql in reversed(list(rules.items())):
        out = F.when(~F.coalesce(F.expr(sql), F.lit(False)), F.lit(label)).otherwise(out)
    return out


def validate(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantine)``; quarantined rows carry ``reject_reason``."""
    marked = typed.withColumn("reject_reason", reject_reason())
    valid = marked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, marked.where(F.col("reject_reason").isNotNull())


def silver_upsert(silver: DataFrame, valid: DataFrame, order: list[Column]) -> DataFrame:
    """Newest row per transaction, merged; a match is rewritten only when it changed."""
    batch = latest_per_key(valid, ["txn_id"], order)
    changed = (
        "NOT (src.status <=> tgt.status AND src.amount <=> tgt.amount "
        "AND src.merchant_id <=> tgt.merchant_id)"
    )
    values = {c: f"src.{c}" for c in ("status", "amount", "merchant_id")}
    return merge(silver, batch, ["txn_id", "txn_date"], [Update(changed, values), Insert()])


# The grain and the column names of the gold reports, and the level they single out.
DAILY_GRAIN = ["txn_date", "payment_mode", "currency"]
DAILY_NAMES = {
    "transactions": "transaction_count",
    "spend": "total_volume",
    "mean": "avg_transaction_value",
    "peak": "max_transaction",
    "groups": "unique_customers",
    "risky": "high_risk_count",
    "risky_spend": "high_risk_volume",
}
PROFILE_NAMES = {
    "transactions": "lifetime_transactions",
    "spend": "lifetime_spend",
    "mean": "avg_transaction_value",
    "newest": "last_transaction_date",
    "listed": "preferred_modes",
    "risky": "fraud_flags",
}
SINGLED_OUT = "HIGH"


def subtotals(scored: DataFrame, by: list[str]) -> DataFrame:
    """Sums that can be added up further, one row per ``by``."""
    risky = F.col("fraud_risk_level") == SINGLED_OUT
    return scored.groupBy(*by).agg(
        F.count("txn_id").alias("transactions"),
        F.count("amount").alias("amounts"),
        F.sum("amount").alias("spend"),
        F.max("amount").alias("peak"),
        F.max("txn_date").alias("newest"),
        F.count_if(risky).alias("risky"),
        F.sum(F.when(risky, F.col("amount")).otherwise(0.0)).alias("risky_spend"),
    )


def rolled_up(parts: DataFrame, by: list[str], inner: str, names: Mapping[str, str]) -> DataFrame:
    """Subtotals per ``by`` and ``inner`` added up per ``by``.

    The values of ``inner`` are one row each by then, so they are counted and listed without a
    distinct aggregate.
    """
    added = {
        "transactions": F.sum("transactions"),
        "spend": F.round(F.sum("spend"), 2),
        "mean": F.round(F.try_divide(F.sum("spend"), F.sum("amounts")), 4),
        "peak": F.max("peak"),
        "newest": F.max("newest"),
        "groups": F.count(inner),
        "listed": F.array_sort(F.collect_list(inner)),
        "risky": F.sum("risky"),
        "risky_spend": F.round(F.sum("risky_spend"), 2),
    }
    return parts.groupBy(*by).agg(*[added[part].alias(name) for part, name in names.items()])


def daily_summary(scored: DataFrame) -> DataFrame:
    """Gold: volume and risk per day, payment mode and currency, from subtotals per customer."""
    by, inner = DAILY_GRAIN, "customer_id"
    return rolled_up(subtotals(scored, [*by, inner]), by, inner, DAILY_NAMES)


def customer_profile(scored: DataFrame) -> DataFrame:
    """Gold: lifetime figures per customer over all history, from subtotals per payment mode."""
    by, inner = ["customer_id"], "payment_mode"
    return rolled_up(subtotals(scored, [*by, inner]), by, inner, PROFILE_NAMES)


def publish_days(report: DataFrame, path: str, generated_at: Column) -> None:
    """Replace the days that ``report`` holds in a table partitioned by ``txn_date``, stamped.

    Other days keep their files; publishing a day again leaves it as published once.
    """
    stamped = report.withColumn("report_generated_at", generated_at.cast("timestamp"))
    replace_partitions(stamped, path, "txn_date")
