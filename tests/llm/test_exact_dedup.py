import uuid

import pytest

from stintlake.llm.exact_dedup import DigestIndex, keep_unique


@pytest.fixture
def index(spark, tmp_path):
    name = f"digests_{uuid.uuid4().hex}"
    yield DigestIndex(spark, name, path=str(tmp_path / "index"), buckets=4)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_groups(index, docs):
    df = docs("A b", "a B", "a b ", None, "", "É", "é", "x")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in index.deduplicate(df).collect()}
    assert got == {
        0: (1, 2, False), 1: (1, 2, True), 2: (2, 1, True), 3: (4, 2, False), 4: (4, 2, True),
        5: (5, 1, True), 6: (6, 1, True), 7: (7, 1, True),
    }


def test_later_batches_meet_the_stored_index(spark, index, docs):
    index.deduplicate(docs((5, "one"), (6, "two"))).collect()
    again = DigestIndex(spark, index.name, buckets=4)
    got = again.deduplicate(docs((9, "ONE"), (10, "three"), (11, "three"))).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {
        (9, 5, False), (10, 11, False), (11, 11, True)
    }
    assert again.read().count() == 3
    plan = (
        docs((1, "x")).selectExpr("unhex(text) AS digest").hint("merge")
        .join(again.read().select("digest").hint("merge"), "digest", "left_anti")
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_repeated_rows_and_null_ids(index, docs):
    df = docs((1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c"), (2, "d"), (None, "d"))
    out = index.deduplicate(df).collect()
    assert len(out) == 7 and sum(r.kept for r in out) == 4
    assert {(r.doc_id, r.keep_id) for r in out if r.kept} == {(1, 1), (None, None), (2, 2)}


def test_keep_unique_keeps_columns(index, docs):
    df = docs((1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c"), (2, "B"), (3, None))
    out = keep_unique(df, index)
    assert out.columns == df.columns
    assert len(out.collect()) == 4
    assert {(r.doc_id, r.text) for r in out.collect()} == {
        (1, "a"), (2, "B"), (None, "c"), (3, None)
    }


def test_empty(index, docs):
    assert index.deduplicate(docs()).count() == 0 and index.read().count() == 0
    assert keep_unique(docs(), index).count() == 0


def test_columns_of_any_name_are_kept(index, docs):
    names = ["repeated", "_id", "_kept", "digest", "_digest", "keep_id", "copies", "one", "row", "kept"]
    df = docs("A", "a", None, "", "B", (4, "B"), "x" * 3_000_000).selectExpr("*", *[f"1 AS {n}" for n in names])
    out = keep_unique(df, index)
    assert out.columns == df.columns
    assert sorted((r.doc_id, len(r.text or "")) for r in out.collect()) == [(1, 1), (3, 0), (4, 1), (6, 3_000_000)]
