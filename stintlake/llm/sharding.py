"""Sharding by sampled splitters: near-equal bytes per shard, records in key order.

Keys are drawn with a probability that follows their size, quantiles of the drawn keys become
splitters, and records are dealt to the ranges between them. Ranges that turn out too large
are subdivided by splitters drawn from their own records, until none is. A running byte sum
inside each range, raised by the totals of earlier ranges, then cuts the shards. The key is
(hash of the text, doc_id, place): copies lie side by side, and a text that holds a third of
all rows is cut like any other. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlake.llm.common import stage

SHARDS = 24
#: Ranges for each shard at least, and rows for each range at most before it is subdivided.
RANGES_PER_SHARD = 8
RANGE_ROWS = 4_000_000
#: Keys drawn for each range.
OVERSAMPLE = 24
#: Bytes that a record counts besides its text.
ROW_BYTES = 8

_KEY = ("key_hash", "doc_id", "place")


def _key() -> Column:
    return F.struct(*_KEY)


def _splitters(rows: DataFrame, ranges: int, by: str = "size") -> list:
    """Quantile boundaries of a sample weighted by a column; at most ``ranges - 1`` keys reach the driver."""
    total = rows.agg(F.sum(by)).first()[0] or 0
    if ranges < 2 or not total:
        return []
    # The chance is proportional to the size; a record beyond one step counts as often as it holds steps.
    step = total / (ranges * OVERSAMPLE)
    weight = F.col(by) / step
    draw = F.floor(weight + F.rand(7)).cast("long")
    drawn = stage(rows.withColumn("draws", draw).filter("draws > 0").select(*_KEY, "draws"), "drawn")
    count = drawn.agg(F.sum("draws")).first()[0]
    if not count:
        return []
    order = Window.orderBy(*_KEY).rowsBetween(Window.unboundedPreceding, 0)
    each = count / ranges
    at = drawn.withColumn("upto", F.sum("draws").over(order))
    band = F.floor((F.col("upto") - 1) / each)
    before = F.floor((F.col("upto") - F.col("draws") - 1) / each)
    return at.filter((band > before) & (F.col("upto") > F.col("draws"))).select(*_KEY).collect()


def _range_of(key: Column, splitters: list, schema: str) -> Column:
    """How many splitters are at or below the key, by binary search in a literal array."""
    if not splitters:
        return F.lit(0)
    values = F.array(*[
        F.struct(*[F.lit(v).cast(t).alias(n) for n, v, t in zip(_KEY, s, schema.split(","))])
        for s in splitters
    ])
    steps = len(splitters).bit_length()
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(splitters)).alias("hi"))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc.lo + acc.hi) / 2).cast("int")
        above = F.coalesce(F.get(values, middle) <= key, F.lit(False))
        done = acc.lo >= acc.hi
        return F.struct(
            F.when(~done & above, middle + 1).otherwise(acc.lo).alias("lo"),
            F.when(~done & ~above, middle).otherwise(acc.hi).alias("hi"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps + 1)), start, halve).lo


def shard_documents(
    docs: DataFrame,
    *,
    shards: int = SHARDS,
    ranges_per_shard: int = RANGES_PER_SHARD,
    range_rows: int = RANGE_ROWS,
    records: bool = False,
) -> DataFrame:
    """Each row of ``docs(doc_id, text)`` with its shard and its slot there.

    Returns doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, shard and slot (gapless
    from 0, in key order). Shards hold near-equal bytes: a shard's share is off by one record
    at most. With ``records`` the whole row follows as the struct ``record``.

    - NULL text: size 8, crc32 0. NULL doc_ids sort first. An empty table gives no rows.
    - Tied and repeated rows each take a slot of their own.
    - Records longer than a shard's share leave shards empty; other columns are ignored.
    """
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    whole = [F.struct(*docs.columns).alias("record")] if records else []
    kept = ["record"] if records else []
    rows = stage(
        docs.select(
            "doc_id",
            (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.xxhash64(body).alias("key_hash"),
            F.monotonically_increasing_id().alias("place"),
            *whole,
        ),
        "sizes",
    )
    kinds = f"bigint,{rows.schema['doc_id'].dataType.simpleString()},bigint"
    n, total = rows.agg(F.count("*"), F.sum("size")).first()
    wanted = max(shards * ranges_per_shard, -(-2 * n // range_rows))
    first = _range_of(_key(), _splitters(rows, wanted), kinds)
    dealt = rows.withColumn("range", F.array(first.cast("int")))
    dealt = _subdivide(stage(dealt, "dealt"), total, wanted, range_rows, kinds)

    in_order = Window.partitionBy("range").orderBy(*_KEY)
    upto = in_order.rowsBetween(Window.unboundedPreceding, 0)
    inside = dealt.withColumns({
        "row_in": F.row_number().over(in_order) - 1,
        "bytes_in": F.sum("size").over(upto) - F.col("size"),
    })
    per_range = dealt.groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        "range",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
    )  # one row per range, a few thousand at most
    middle = F.col("bytes_before") + F.col("bytes_in") + F.floor(F.col("size") / 2)
    placed = stage(
        inside.join(F.broadcast(offsets), "range").select(
            "doc_id", "size", "text_crc32", *kept,
            F.expr("rows_before + row_in").alias("row"),
            F.least(F.floor(middle * shards / F.lit(total or 1)), F.lit(shards - 1))
            .cast("int").alias("shard"),
        ),
        "placed",
    )
    starts = placed.groupBy("shard").agg(F.min("row").alias("first_row"))  # one row per shard
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("row") - F.col("first_row")).alias("slot"), *kept,
    )


def _subdivide(dealt: DataFrame, total: int, wanted: int, range_rows: int, kinds: str) -> DataFrame:
    """Split ranges with over four fair shares of the bytes or over ``range_rows`` rows, until none is.

    A range is the list of its places, one for each round. One that a round by bytes leaves whole,
    since a single long text makes it large, stays.
    """
    fair = (total or 0) / max(1, wanted)
    over = (F.col("bytes") > 4 * fair) & (F.col("n") > 1) | (F.col("n") > range_rows)
    had: dict[tuple, int] = {}
    while True:
        sizes = (
            dealt.groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
            .filter(over).orderBy("range").collect()
        )
        large = [r for r in sizes if r["n"] > range_rows or had.get(tuple(r["range"][:-1])) != r["n"]]
        if not large:
            return dealt
        for r in large:  # few: the sample bounds a range's bytes; rows differ only where texts are short
            mine = F.col("range") == F.array(*map(F.lit, r["range"]))
            parts = max(2, int(max(r["bytes"] / max(fair, 1), 2 * r["n"] / range_rows)) + 1)
            rows = dealt.filter(mine).withColumn("one", F.lit(1))
            by = "one" if r["n"] > range_rows else "size"
            finer = _range_of(_key(), _splitters(rows, parts, by), kinds).cast("int")
            dealt = dealt.withColumn(
                "range", F.when(mine, F.concat("range", F.array(finer))).otherwise(F.col("range"))
            )
            had[tuple(r["range"])] = r["n"]
        dealt = stage(dealt, "subdivided")


def write_shards(docs: DataFrame, path: str, **options: int) -> None:
    """Write slot and record of each row of ``docs``, one folder per shard, by rising slot."""
    placed = shard_documents(docs, records=True, **options).select("shard", "slot", "record")
    (
        placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(path)
    )
