"""Declarative data-quality checks.

A check counts violations; nothing is collected. All row-level checks of a table
run in one pass over it, and all checks of its keys in another.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One check on a table; ``expr`` is SQL text that a good row satisfies."""

    name: str
    kind: str  # row | unique | relationship
    expr: str = ""
    where: str = ""
    severity: str = "error"
    parent: tuple[str, str] = field(default=("", ""))


def not_null(column: str) -> Check:
    return Check(f"not_null_{column}", "row", f"{column} IS NOT NULL")


def accepted(column: str, values: Sequence, severity: str = "error") -> Check:
    """Values outside the list violate; NULL passes."""
    listed = ", ".join(str(v).lower() if isinstance(v, bool) else f"'{v}'" for v in values)
    return Check(f"accepted_values_{column}", "row", f"{column} IN ({listed})", "", severity)


def expression(name: str, expr: str, where: str = "", severity: str = "error") -> Check:
    """Rows for which the expression is false violate; NULL passes."""
    return Check(name, "row", expr, where, severity)


def implies(name: str, condition: str, then: str) -> Check:
    """Rows that meet the condition must meet the consequence."""
    return Check(name, "row", f"CASE WHEN {condition} THEN {then} ELSE TRUE END")


def unique(name: str, expr: str) -> Check:
    """Values that occur more than once violate; NULL is ignored."""
    return Check(f"unique_{name}", "unique", expr)


def relationship(column: str, parent: str, parent_column: str) -> Check:
    """Values without a row in the parent table violate; NULL is ignored."""
    return Check(f"relationships_{column}", "relationship", column, parent=(parent, parent_column))


def violates(check: Check) -> Column:
    bad = ~F.expr(check.expr)
    if check.where:
        bad = bad & F.expr(check.where)
    return F.coalesce(bad, F.lit(False))


def _labelled(check: Check, table: str, count: Column) -> Column:
    ok = count == 0
    status = F.when(ok, "pass").otherwise("warn" if check.severity == "warn" else "fail")
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        count.cast("long").alias("violations"),
        status.alias("status"),
    )


def check_table(
    name: str, df: DataFrame, checks: Sequence[Check], tables: dict[str, DataFrame]
) -> list[DataFrame]:
    rows = [c for c in checks if c.kind == "row"]
    out = []
    if rows:
        counted = df.agg(*[F.count_if(violates(c)).alias(f"_{i}") for i, c in enumerate(rows)])
        labelled = [_labelled(c, name, F.col(f"_{i}")) for i, c in enumerate(rows)]
        out.append(counted.select(F.inline(F.array(*labelled))))
    keyed = [c for c in checks if c.kind != "row"]
    if keyed:
        counts = _key_violations(df, keyed, tables)
        labelled = [_labelled(c, name, F.col(f"_{i}")) for i, c in enumerate(keyed)]
        out.append(counts.select(F.inline(F.array(*labelled))))
    return out


def _key_violations(
    df: DataFrame, checks: Sequence[Check], tables: dict[str, DataFrame]
) -> DataFrame:
    """One row with the violations of each unique and relationship check, from one pass.

    The table is reduced to its distinct keys with their counts before anything is joined, so a
    key with very many rows meets its parent once.
    """
    pairs = [
        F.struct(F.lit(i).alias("_i"), F.expr(c.expr).cast("string").alias("_k"))
        for i, c in enumerate(checks)
    ]
    keys = (
        df.select(F.inline(F.array(*pairs))).filter("_k IS NOT NULL")
        .groupBy("_i", "_k").agg(F.count("*").alias("_n"))
    )
    known = [
        tables[c.parent[0]].select(
            F.lit(i).alias("_i"), F.col(c.parent[1]).cast("string").alias("_k")
        )
        for i, c in enumerate(checks) if c.kind == "relationship"
    ]
    if known:
        parents = reduce(DataFrame.unionByName, known).distinct().withColumn("_known", F.lit(True))
        keys = keys.join(parents, ["_i", "_k"], "left")
    else:
        keys = keys.withColumn("_known", F.lit(False))
    sums = []
    for i, c in enumerate(checks):
        if c.kind == "unique":
            bad = F.when(F.col("_n") > 1, 1)
        else:
            bad = F.when(F.col("_known").isNull(), F.col("_n"))
        own = F.when(F.col("_i") == i, bad).cast("long")
        sums.append(F.coalesce(F.sum(own), F.lit(0)).alias(f"_{i}"))
    return keys.agg(*sums)


def run_checks(
    tables: dict[str, DataFrame], checks: dict[str, Sequence[Check]]
) -> DataFrame:
    """One row per check: table, check, severity, number of violations, status."""
    parts = [
        part for name, listed in checks.items()
        for part in check_table(name, tables[name], listed, tables)
    ]
    return reduce(DataFrame.unionByName, parts)


# --- checks that return the offending values ---------------------------------


def _value_counts(df: DataFrame, column: str, bad: Column, name: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull() & bad)
        .groupBy(F.col(column).alias(name))
        .agg(F.count("*").alias("violation_count"))
    )


def no_future_dates(df: DataFrame, column: str, now: Column | None = None) -> DataFrame:
    limit = F.current_timestamp() if now is None else now
    return _value_counts(df, column, F.col(column) > limit, "date_value")


def positive_values(df: DataFrame, column: str) -> DataFrame:
    return _value_counts(df, column, F.col(column) <= 0, "value")


def reasonable_lap_time(df: DataFrame, column: str, lo: float = 30, hi: float = 300) -> DataFrame:
    return _value_counts(df, column, ~F.col(column).between(lo, hi), "lap_time")


def valid_percentage(df: DataFrame, column: str) -> DataFrame:
    return _value_counts(df, column, ~F.col(column).between(0, 100), "percentage_value")


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of non-NULL values per column, in one pass."""
    counted = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(f"_c_{c}") for c in columns])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"_c_{c}").alias("present"),
            F.col("_n").alias("total"),
            F.round(F.col(f"_c_{c}") / F.nullif(F.col("_n"), F.lit(0)), 6).alias("completeness"),
        )
        for c in columns
    ]
    return counted.select(F.inline(F.array(*rows)))
