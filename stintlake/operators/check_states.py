"""Checks by stored states: a load is checked alone, and its states are merged with those kept.

For tables that only grow. The state of a row check is its number of violations in a load, and these
add up. The state of a check of keys is the distinct keys of a load with their counts, those that
stand in the parent table too; a key may be repeated, or find its parent, in any later load, in either order.
These states lie in buckets of the key, and a load judges the buckets that its own keys fall into.
The result of a bucket stands until a load touches it again, so the merged result adds up small numbers
and always equals a check of the whole tables.

Every write of a load replaces what the same load wrote before, so a load that stopped is repeated
with the same rows. Buckets of loads that did not end are judged again by whichever load comes next.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.operators.quality import Check, violates
from stintlake.sources.writers import BATCH, append_table, claim, list_names, read_table, write_table

#: Buckets of the keys' states; a load reads the states of those it touches.
BUCKETS = 64
Checks = dict[str, Sequence[Check]]

_ROW_STATES = "table_name string, place int, violations long"
_KEY_STATES = "bucket int, table_name string, place int, key string, is_unique boolean, n long, known boolean"


def row_states(spark: SparkSession, tables: dict[str, DataFrame], checks: Checks) -> DataFrame:
    """Violations of each row check in the given rows, one pass for each table."""
    parts = [spark.createDataFrame([], _ROW_STATES)]
    for name, df in tables.items():
        rows = [(i, c) for i, c in enumerate(checks.get(name, ())) if c.kind == "row"]
        if rows:
            counted = df.agg(*[F.count_if(violates(c)).alias(f"_{i}") for i, c in rows])
            states = [
                F.struct(F.lit(name).alias("table_name"), F.lit(i).alias("place"), F.col(f"_{i}").alias("violations"))
                for i, _ in rows
            ]
            parts.append(counted.select(F.inline(F.array(*states))))
    return reduce(DataFrame.unionByName, parts)


def key_states(
    spark: SparkSession, tables: dict[str, DataFrame], checks: Checks, buckets: int = BUCKETS
) -> DataFrame:
    """Distinct keys of each unique and relationship check in the given rows, with their counts.

    Keys of a parent table count nothing and are ``known``. NULL keys are left out. A key with very many
    rows is brought down to one row before the shuffle.
    """
    parts = [spark.createDataFrame([], "table_name string, place int, key string, is_unique boolean, n int, known boolean")]
    for name, df in tables.items():
        keys = [
            (name, i, c.expr, c.kind == "unique", 1)
            for i, c in enumerate(checks.get(name, ())) if c.kind != "row"
        ] + [
            (child, i, c.parent[1], False, 0)
            for child, listed in checks.items() for i, c in enumerate(listed)
            if c.kind == "relationship" and c.parent[0] == name
        ]
        if keys:
            states = [
                F.struct(
                    F.lit(table).alias("table_name"), F.lit(i).alias("place"),
                    F.expr(expr).cast("string").alias("key"), F.lit(is_unique).alias("is_unique"),
                    F.lit(n).alias("n"), F.lit(n == 0).alias("known"),
                )
                for table, i, expr, is_unique, n in keys
            ]
            parts.append(df.select(F.inline(F.array(*states))))
    where = F.pmod(F.hash("table_name", "place", "key"), F.lit(buckets)).alias("bucket")
    return (
        reduce(DataFrame.unionByName, parts).filter("key IS NOT NULL")
        .groupBy("table_name", "place", "key", "is_unique")
        .agg(F.sum("n").alias("n"), F.bool_or("known").alias("known"))
        .select(where, "table_name", "place", "key", "is_unique", "n", "known")
    )


def key_violations(states: DataFrame) -> DataFrame:
    """Violations per bucket and check, from the states of all loads.

    A unique value that occurs more than once is one violation; a value without a parent is one for each row.
    """
    keys = states.groupBy("bucket", "table_name", "place", "key", "is_unique").agg(
        F.sum("n").alias("n"), F.bool_or("known").alias("known")
    )
    bad = F.when(F.col("is_unique"), (F.col("n") > 1).cast("long")).otherwise(
        F.when(~F.col("known"), F.col("n")).otherwise(0)
    )
    return keys.groupBy("bucket", "table_name", "place").agg(F.sum(bad).alias("violations"))


def _loads(spark: SparkSession, path: str) -> set[str]:
    return {
        unquote(n.removeprefix(f"{BATCH}=")) for n in list_names(spark, f"{path}/keys")
        if n.startswith(f"{BATCH}=")
    }


def check_load(
    spark: SparkSession, tables: dict[str, DataFrame], checks: Checks, path: str, load: str, buckets: int = BUCKETS
) -> set[int]:
    """Check the rows that a load brings to some tables and keep their states below ``path``.

    Returns the buckets that were judged: those of this load, and of loads that did not end. Their numbers
    are at most ``buckets``, which stays the same for a store.
    """
    append_table(row_states(spark, tables, checks), f"{path}/rows", load)
    append_table(key_states(spark, tables, checks, buckets), f"{path}/keys", load, ["bucket"])
    ended = {unquote(n) for n in list_names(spark, f"{path}/ended")}
    open_ = (_loads(spark, path) - ended) | {load}
    states = spark.read.schema(f"{_KEY_STATES}, {BATCH} string").parquet(f"{path}/keys")
    touched = {
        r[0] for r in states.filter(F.col(BATCH).isin(sorted(open_))).select("bucket").distinct().collect()
    }
    if touched:
        judged = key_violations(states.filter(F.col("bucket").isin(sorted(touched))))
        write_table(judged, f"{path}/found", "overwrite", ["bucket"], dynamic=True)
    for name in sorted(open_ - ended):
        claim(spark, f"{path}/ended/{quote(name, safe='')}", "ended")
    return touched


def merged_checks(spark: SparkSession, path: str, checks: Checks) -> DataFrame:
    """One row per check over all loads kept, as :func:`stintlake.operators.quality.run_checks` gives it."""
    states = read_table(spark, f"{path}/rows").select("table_name", "place", "violations")
    if list_names(spark, f"{path}/found"):
        found = spark.read.parquet(f"{path}/found")
        states = states.unionByName(found.select("table_name", "place", "violations"))
    sums = states.groupBy("table_name", "place").agg(F.sum("violations").alias("_sum"))
    listed = spark.createDataFrame(
        [(t, i, c.name, c.severity) for t, cs in checks.items() for i, c in enumerate(cs)],
        "table_name string, place int, check_name string, severity string",
    )
    violations = F.coalesce("_sum", F.lit(0).cast("long"))
    status = F.when(violations == 0, "pass").otherwise(F.when(F.col("severity") == "warn", "warn").otherwise("fail"))
    return listed.join(sums, ["table_name", "place"], "left").select(
        "table_name", "check_name", "severity", violations.alias("violations"), status.alias("status")
    )
