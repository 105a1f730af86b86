"""User functions, masking, row filters and personal-data scans."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.catalogue.registry import Tables, query
from lakeloom.functions import masking
from lakeloom.operators import access

CATEGORY_SQL = "SELECT p_partkey, CASE WHEN p_retailprice < 1000 THEN 'LOW' WHEN p_retailprice < 1500 THEN 'MEDIUM' ELSE 'HIGH' END AS category FROM part"


@query("g01_scalar_udf_as_expression", CATEGORY_SQL)
def g01(t: Tables):
    """What a row-at-a-time Python function would do, kept inside code generation."""
    price = F.col("p_retailprice")
    return t.part.select("p_partkey", F.when(price < 1000, "LOW").when(price < 1500, "MEDIUM").otherwise("HIGH").alias("category"))


def pan(key):
    return F.concat(F.lit("ABCDE"), F.lpad((key % 10000).cast("string"), 4, "0"), F.lit("F"))


@query("g02_identity_card_mask", "SELECT c_custkey, 'XXXXX' || LPAD(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || 'X' AS pan FROM customer")
def g02(t: Tables):
    return t.customer.select("c_custkey", masking.mask_identity_card(pan(F.col("c_custkey"))).alias("pan"))


@query("g03_pandas_scalar_udf", "SELECT p_partkey, p_retailprice * 1.18 AS with_tax FROM part")
def g03(t: Tables):
    @F.pandas_udf(T.DoubleType())
    def with_tax(price: pd.Series) -> pd.Series:
        return price * 1.18

    return t.part.select("p_partkey", with_tax("p_retailprice").alias("with_tax"))


@query("g04_partition_wise_function", "SELECT event_id, value * 2 AS doubled FROM events WHERE value > 50")
def g04(t: Tables):
    """A function over the Arrow batches of a partition; it holds one batch at a time."""

    def transform(batches):
        for pdf in batches:
            kept = pdf[pdf["value"] > 50]
            yield pd.DataFrame({"event_id": kept["event_id"], "doubled": kept["value"] * 2})

    return t.events.select("event_id", "value").mapInPandas(transform, "event_id bigint, doubled double")


@query("g06_sql_functions", "SELECT c_custkey, 'XXXXX' || LPAD(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || 'X' AS pan FROM customer WHERE c_nationkey % 2 = 0")
def g06(t: Tables):
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION loom_mask(s STRING) RETURNS STRING RETURN concat('XXXXX', substr(s, 6, 4), 'X')")
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION loom_visible(nation INT) RETURNS BOOLEAN RETURN nation % 2 = 0")
    t.customer.withColumn("pan", pan(F.col("c_custkey"))).createOrReplaceTempView("loom_people")
    return t.spark.sql("SELECT c_custkey, loom_mask(pan) AS pan FROM loom_people WHERE loom_visible(c_nationkey)")


def people(t: Tables):
    key = F.col("c_custkey")
    return t.customer.select(
        "c_custkey",
        F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.lpad((key % 10_000_000_000).cast("string"), 10, "5").alias("phone"),
        pan(key).alias("pan"),
        "c_nationkey",
    )


POLICY = dict(
    clear={"email": ("compliance",), "phone": ("compliance",), "pan": ("compliance", "engineering")},
    rows={"global": "TRUE", "even": "c_nationkey % 2 = 0", "three": "c_nationkey = 3"},
)


def policy():
    made = {
        "email": masking.mask_email(F.col("email")),
        "phone": masking.mask_phone(F.col("phone")),
        "pan": masking.mask_identity_card(F.col("pan")),
    }
    return access.Policy({c: (POLICY["clear"][c], m) for c, m in made.items()}, POLICY["rows"])


_PEOPLE = """people AS (SELECT c_custkey, 'user' || c_custkey || '@example.com' AS email, LPAD(CAST(c_custkey AS VARCHAR), 10, '5') AS phone,
  'ABCDE' || LPAD(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || 'F' AS pan, c_nationkey FROM customer)"""


@query("g07_column_masking_by_role", f"WITH {_PEOPLE} SELECT c_custkey, LEFT(email, 3) || '****@****.com' AS email, 'XXXXXX' || RIGHT(phone, 4) AS phone, pan, c_nationkey FROM people")
def g07(t: Tables):
    return access.secure_view(people(t), policy(), {"engineering", "global"})


@query("g08_row_filter_by_role", f"WITH {_PEOPLE} SELECT c_custkey, email, phone, pan, c_nationkey FROM people WHERE c_nationkey % 2 = 0 OR c_nationkey = 3")
def g08(t: Tables):
    return access.secure_view(people(t), policy(), {"compliance", "even", "three"})


@query("g09_secure_view", f"WITH {_PEOPLE} SELECT c_custkey, LEFT(email, 3) || '****@****.com' AS email, 'XXXXXX' || RIGHT(phone, 4) AS phone, 'XXXXX' || SUBSTRING(pan, 6, 4) || 'X' AS pan, c_nationkey FROM people WHERE c_nationkey = 3")
def g09(t: Tables):
    return access.secure_view(people(t), policy(), {"three"})


@query("g10_pseudonyms", "SELECT c_custkey, sha256('pepper' || CAST(c_custkey AS VARCHAR)) AS pseudonym FROM customer")
def g10(t: Tables):
    return t.customer.select("c_custkey", masking.pseudonym(F.col("c_custkey"), "pepper").alias("pseudonym"))


_SCAN = " UNION ALL ".join(
    f"SELECT 'text' AS column_name, '{kind}' AS pii_type, CAST(SUM(len(regexp_extract_all(text, '{p}'))) AS BIGINT) AS matches, COUNT(*) FILTER (WHERE regexp_matches(text, '{p}')) AS rows_hit FROM documents"
    for kind, p in masking.PII_PATTERNS.items()
)


@query("g11_pii_scan", _SCAN)
def g11(t: Tables):
    return access.pii_scan(t.documents, ["text"])


_TEXTS = {"documents": ("text", "lang", "source"), "conversations": ("role", "text")}
_ANY = {
    (n, c): " OR ".join(f"regexp_matches({c}, '{p}')" for p in masking.PII_PATTERNS.values()) for n, columns in _TEXTS.items() for c in columns
}


@query(
    "g12_pii_tag_inventory",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, '{c}' AS column_name FROM (SELECT COUNT(*) FILTER (WHERE {any_}) AS hits FROM {n}) WHERE hits > 0" for (n, c), any_ in _ANY.items()
    ),
)
def g12(t: Tables):
    """Columns that hold personal data, tagged by scanning their rows."""
    tags = None
    for name, columns in _TEXTS.items():
        hits = access.pii_scan(getattr(t, name), columns).groupBy("column_name").agg(F.max(F.col("matches") > 0).cast("string").alias("tag_value"))
        own = hits.select(F.lit(name).alias("table_name"), "column_name", F.lit("pii").alias("tag_name"), "tag_value")
        tags = own if tags is None else tags.unionByName(own)
    return access.tagged_columns(tags)
