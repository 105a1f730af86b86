"""The list of catalogue queries and the tables they read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """The input tables of one scale, read on first use, and frames derived from them."""

    NAMES = (
        "region nation customer supplier part orders lineitem events documents embeddings "
        "pages benchmark labels conversations"
    ).split()

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, df)
        return df

    @cached_property
    def txn(self) -> DataFrame:
        """Orders as payment transactions; the SQL twin is ``TXN``."""
        mode = (
            F.when(F.col("o_orderpriority") == "1-URGENT", "CARD")
            .when(F.col("o_orderpriority") == "2-HIGH", "UPI")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "NETBANKING")
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "NEFT")
            .otherwise("WALLET")
        )
        status = (
            F.when(F.col("o_orderstatus") == "F", "COMPLETED")
            .when(F.col("o_orderstatus") == "O", "PENDING")
            .otherwise("FAILED")
        )
        second = F.col("o_orderkey") * 37 % 86400
        return self.orders.select(
            F.col("o_orderkey").alias("txn_id"),
            F.concat(F.lit("C"), (F.col("o_custkey") + 100000).cast("string")).alias("customer_id"),
            F.to_date("o_orderdate").alias("txn_date"),
            F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + second).alias("txn_ts"),
            F.col("o_totalprice").alias("amount"),
            mode.alias("payment_mode"),
            status.alias("status"),
            F.element_at(F.array(*map(F.lit, ("INR", "USD", "EUR", "GBP"))), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("currency"),
            F.concat(F.lit("M"), (F.col("o_orderkey") % 500).cast("string")).alias("merchant_id"),
        )

    @cached_property
    def dirty(self) -> DataFrame:
        """Transactions with defects placed by a fixed rule; the SQL twin is ``DIRTY``."""
        k = F.col("txn_id")
        return self.txn.withColumns(
            {
                "amount": F.when(k % 97 == 1, F.lit(None)).when(k % 89 == 2, -F.col("amount")).otherwise(F.col("amount")),
                "customer_id": F.when(k % 83 == 3, F.lit(None)).when(k % 79 == 4, "X-1").otherwise(F.col("customer_id")),
                "payment_mode": F.when(k % 71 == 5, "BARTER").otherwise(F.col("payment_mode")),
                "status": F.when(k % 61 == 6, "CANCELLED").otherwise(F.col("status")),
                "merchant_id": F.when(k % 53 == 7, F.lit(None)).otherwise(F.col("merchant_id")),
            }
        )

    @cached_property
    def customers(self) -> DataFrame:
        """Customers with city and tier; the SQL twin is ``CUST``."""
        city = self.nation.select("n_nationkey", F.col("n_name").alias("city"))
        return self.customer.join(city, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.concat(F.lit("C"), (F.col("c_custkey") + 100000).cast("string")).alias("customer_id"),
            F.col("c_name").alias("name"),
            "city",
            F.col("c_mktsegment").alias("tier"),
            F.col("c_acctbal").alias("balance"),
        )


# SQL twins of the derived frames, to be used as ``WITH {TXN}, ...``.
TXN = """txn AS (
  SELECT o_orderkey AS txn_id, 'C' || CAST(o_custkey + 100000 AS VARCHAR) AS customer_id,
    CAST(o_orderdate AS DATE) AS txn_date,
    o_orderdate + to_seconds(CAST((o_orderkey * 37) % 86400 AS BIGINT)) AS txn_ts,
    o_totalprice AS amount,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'CARD' WHEN '2-HIGH' THEN 'UPI'
      WHEN '3-MEDIUM' THEN 'NETBANKING' WHEN '4-NOT SPECIFIED' THEN 'NEFT' ELSE 'WALLET' END AS payment_mode,
    CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' ELSE 'FAILED' END AS status,
    CASE o_orderkey % 4 WHEN 0 THEN 'INR' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' ELSE 'GBP' END AS currency,
    'M' || CAST(o_orderkey % 500 AS VARCHAR) AS merchant_id
  FROM orders)"""

DIRTY = (
    TXN
    + """, dirty AS (
  SELECT txn_id,
    CASE WHEN txn_id % 83 = 3 THEN NULL WHEN txn_id % 79 = 4 THEN 'X-1' ELSE customer_id END AS customer_id,
    txn_date, txn_ts,
    CASE WHEN txn_id % 97 = 1 THEN NULL WHEN txn_id % 89 = 2 THEN -amount ELSE amount END AS amount,
    CASE WHEN txn_id % 71 = 5 THEN 'BARTER' ELSE payment_mode END AS payment_mode,
    CASE WHEN txn_id % 61 = 6 THEN 'CANCELLED' ELSE status END AS status, currency,
    CASE WHEN txn_id % 53 = 7 THEN NULL ELSE merchant_id END AS merchant_id
  FROM txn)"""
)

CUST = """cust AS (
  SELECT 'C' || CAST(c_custkey + 100000 AS VARCHAR) AS customer_id, c_name AS name, n_name AS city,
    c_mktsegment AS tier, c_acctbal AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a catalogue query with the SQL that must return the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"duplicate query {name}")
        ENTRIES[name] = Entry(name, build, sql)
        return build

    return register
