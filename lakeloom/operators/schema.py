"""Schema evolution, enforcement, constraints and generated columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def append_evolving(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Append a batch that may bring new columns or miss old ones."""
    return target.unionByName(batch, allowMissingColumns=True)


def schema_differences(expected: T.StructType, actual: T.StructType) -> list[tuple[str, str, str, str]]:
    """``(column, issue, expected type, actual type)`` for every deviation."""
    want = {f.name: f.dataType.simpleString() for f in expected}
    have = {f.name: f.dataType.simpleString() for f in actual}
    out = [(c, "missing", t, "") for c, t in want.items() if c not in have]
    out += [(c, "extra", "", t) for c, t in have.items() if c not in want]
    out += [(c, "type_changed", t, have[c]) for c, t in want.items() if c in have and have[c] != t]
    return sorted(out)


def schema_report(expected: T.StructType, df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        schema_differences(expected, df.schema),
        "column_name string, issue string, expected_type string, actual_type string",
    )


def enforce_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """``df`` in the expected column order, or an error that lists every deviation."""
    problems = schema_differences(expected, df.schema)
    if problems:
        raise ValueError(f"schema mismatch: {problems}")
    return df.select(*expected.names)


def constraint_violations(df: DataFrame, constraints: Mapping[str, str]) -> DataFrame:
    """Rows that break each constraint; a NULL condition counts as broken."""
    broken = [
        F.count(F.when(~F.coalesce(F.expr(sql), F.lit(False)), F.lit(1))).alias(name)
        for name, sql in constraints.items()
    ]
    return df.agg(*broken).unpivot([], list(constraints), "constraint_name", "violations")


def checked_write(df: DataFrame, constraints: Mapping[str, str]) -> DataFrame:
    """``df``, failing the whole query at the first row that breaks a constraint.

    The check is part of the plan, so writing needs no extra pass over the data.
    """
    broken = F.lit(None).cast("string")
    for name, sql in reversed(list(constraints.items())):
        broken = F.when(~F.coalesce(F.expr(sql), F.lit(False)), F.lit(name)).otherwise(broken)
    message = F.concat(F.lit("constraint violated: "), F.col("_broken"))
    fails = F.when(F.col("_broken").isNotNull(), F.raise_error(message).cast("boolean"))
    return df.withColumn("_broken", broken).where(fails.isNull()).drop("_broken")


def generate_columns(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """Columns derived from others on write; each may use those before it."""
    for name, made in columns.items():
        df = df.withColumn(name, F.expr(made) if isinstance(made, str) else made)
    return df


def alter_columns(
    df: DataFrame,
    add: Mapping[str, str] | None = None,
    rename: Mapping[str, str] | None = None,
    retype: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add NULL columns, rename and change types."""
    df = df.withColumns({c: F.lit(None).cast(t) for c, t in (add or {}).items()})
    df = df.withColumnsRenamed(dict(rename or {}))
    return df.withColumns({c: F.col(c).cast(t) for c, t in (retype or {}).items()})
