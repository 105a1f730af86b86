"""Rule-based fraud scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.ordered import rolling_sums, with_rolling_sums


@dataclass(frozen=True)
class FraudSettings:
    high_value: float = 500_000
    velocity_seconds: int = 3_600
    velocity_limit: int = 10
    mean_days: int = 30
    mean_factor: float = 3
    round_unit: float = 10_000
    round_floor: float = 100_000


# Points per flag, and the least score of each level.
POINTS = {
    "flag_high_value": 30,
    "flag_high_velocity": 40,
    "flag_amount_anomaly": 20,
    "flag_round_amount": 10,
}
LEVELS = {"HIGH": 60, "MEDIUM": 30, "LOW": 10}


def recent_count(
    df: DataFrame, key: str, at: str, seconds: int, name: str = "txn_count_recent"
) -> DataFrame:
    """Rows of the same key in the ``seconds`` up to and including each row."""
    second = F.unix_seconds(F.col(at))
    return with_rolling_sums(df, [key], second, -seconds, 0, {}, {name: F.lit(1)}, span=max(86_400, 8 * seconds))


def prior_daily_mean(df: DataFrame, key: str, day: str, amount: str, days: int) -> DataFrame:
    """``key, day, avg_prior``: mean amount over the ``days`` calendar days before each day."""
    amounts = F.col(amount)
    totals = rolling_sums(df, [key], F.unix_date(day), -days, -1, {"_sum": amounts}, {"_n": amounts}, span=12 * days)
    return totals.select(
        F.col(f"_a.`{key}`").alias(key),
        F.date_from_unix_date(F.col("_a._at").cast("int")).alias(day),
        F.try_divide("_sum", "_n").alias("avg_prior"),
    )


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def risk_level(score: Column) -> Column:
    out = F.when(F.lit(False), F.lit(None))
    for label, least in LEVELS.items():
        out = out.when(score >= least, label)
    return out.otherwise("NORMAL")


def score(df: DataFrame, settings: FraudSettings = FraudSettings()) -> DataFrame:
    """Add the four flags, ``fraud_score`` and ``fraud_risk_level``.

    ``df`` holds ``txn_id, customer_id, txn_date, txn_ts, amount`` and reaches back far
    enough for the longest rule; score first and cut to the wanted dates afterwards.
    """
    s = settings
    counted = recent_count(df, "customer_id", "txn_ts", s.velocity_seconds)
    means = prior_daily_mean(df, "customer_id", "txn_date", "amount", s.mean_days)
    flagged = counted.join(means, ["customer_id", "txn_date"], "left").withColumns(
        {
            "flag_high_value": flag(F.col("amount") > s.high_value),
            "flag_high_velocity": flag(F.col("txn_count_recent") > s.velocity_limit),
            "flag_amount_anomaly": flag(F.col("amount") > F.col("avg_prior") * s.mean_factor),
            "flag_round_amount": flag(
                (F.col("amount") % s.round_unit == 0) & (F.col("amount") >= s.round_floor)
            ),
        }
    )
    total = F.lit(0)
    for name, points in POINTS.items():
        total = total + F.col(name).cast("int") * points
    return flagged.withColumn("fraud_score", total).withColumn(
        "fraud_risk_level", risk_level(F.col("fraud_score"))
    )
