import zlib

import pytest

from stintlake.llm import sharding
from stintlake.llm.sharding import shard_documents, write_shards


def check(df, texts, shards):
    rows = shard_documents(df, shards=shards, ranges_per_shard=4).collect()
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted(
        (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in texts
    )
    sums = [0] * shards
    for s in range(shards):
        mine = [r for r in rows if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        sums[s] = sum(r.size for r in mine)
    assert sum(sums) == sum(r.size for r in rows)
    return sums, max((r.size for r in rows), default=0)


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_near_equal_bytes(docs, shards):
    texts = [f"{i} é " * (i * 37 % 91) for i in range(700)] + ["hot"] * 900 + [None, ""]
    sums, largest = check(docs(*texts).repartition(3), texts, shards)
    assert max(sums) - min(sums) <= 2 * largest


def test_repeated_rows_and_null_ids(docs):
    texts = ["same text"] * 400
    sums, largest = check(docs(*[(None, t) for t in texts]), texts, 6)
    assert max(sums) - min(sums) <= 2 * largest


def test_long_and_empty(docs):
    sums, _ = check(docs("x" * 100_000, "a", "b"), ["x" * 100_000, "a", "b"], 4)
    assert sum(sums) == 100_026
    assert shard_documents(docs()).count() == 0


def test_many_ranges_are_subdivided(docs):
    texts = [f"row {i}" for i in range(500)]
    rows = shard_documents(docs(*texts), shards=2, ranges_per_shard=1, range_rows=50).collect()
    for s in range(2):
        mine = [r for r in rows if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))


def test_written_shards(spark, docs, tmp_path):
    write_shards(docs("a", "bb", None).withColumnRenamed("lang", "shard"), str(tmp_path / "s"), shards=2)
    back = spark.read.parquet(str(tmp_path / "s")).select("shard", "slot", "record.*").collect()
    assert {r.text for r in back} == {"a", "bb", None}


def test_no_range_keeps_more_rows_than_its_limit(docs, monkeypatch):
    seen = []
    cut = sharding._subdivide

    def watched(*args):
        seen.append(cut(*args))
        return seen[-1]

    monkeypatch.setattr(sharding, "_subdivide", watched)
    df = docs(*[None] * 600, *[f"{i} " * 40_000 for i in range(6)])
    assert shard_documents(df, shards=2, ranges_per_shard=2, range_rows=100).count() == 606
    assert max(r["count"] for r in seen[0].groupBy("range").count().collect()) <= 100
