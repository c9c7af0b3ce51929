"""Merged states of checks against checks of the whole tables."""

import pytest

from stintlake.operators import check_states as S
from stintlake.operators import quality as Q

CHECKS = {
    "child": [
        Q.not_null("k"), Q.unique("id", "id"), Q.relationship("k", "parent", "id"),
        Q.accepted("v", ["a"]), Q.accepted("v", ["a", "b"], "warn"), Q.expression("positive", "n > 0", "v = 'a'"),
    ],
    "parent": [Q.unique("id", "id"), Q.relationship("boss", "parent", "id")],
}
CHILD = "id long, k long, v string, n double"
PARENT = "id long, boss long"


def loads(spark):
    """Rows of three loads: children before their parents, keys repeated later, one table alone."""
    child = [
        [(1, 10, "a", 1.0), (2, 11, "b", -1.0), (None, None, None, None)],
        [(1, 12, "z", 0.0), (3, 10, "a", -1.0), (3, 99, "a", None)],
        [(2, 11, "b", 1.0), (1, 99, "q", 1.0)],
    ]
    parent = [[(12, None)], [(10, 12), (10, 50)], None]
    out = []
    for c, p in zip(child, parent):
        tables = {"child": spark.createDataFrame(c, CHILD)}
        if p is not None:
            tables["parent"] = spark.createDataFrame(p, PARENT)
        out.append(tables)
    return out


def whole(spark, seen, rows):
    tables = {}
    for name, schema in (("child", CHILD), ("parent", PARENT)):
        tables[name] = spark.createDataFrame([], schema)
        for part in seen:
            if name in part:
                tables[name] = tables[name].unionByName(part[name])
    return rows(Q.run_checks(tables, CHECKS))


def test_each_load_gives_the_check_of_all_rows_so_far(spark, tmp_path, rows):
    path, seen = str(tmp_path / "states"), []
    for i, part in enumerate(loads(spark)):
        seen.append(part)
        S.check_load(spark, part, CHECKS, path, f"load {i}/x", buckets=8)
        assert rows(S.merged_checks(spark, path, CHECKS)) == whole(spark, seen, rows)
    S.check_load(spark, seen[1], CHECKS, path, "load 1/x", buckets=8)  # repeated
    assert rows(S.merged_checks(spark, path, CHECKS)) == whole(spark, seen, rows)


@pytest.mark.parametrize("stop", ["key_states", "key_violations"])
def test_a_stop_is_made_good_by_the_next_load(spark, tmp_path, rows, monkeypatch, stop):
    path, (one, two, three) = str(tmp_path / "states"), loads(spark)
    S.check_load(spark, one, CHECKS, path, "one", buckets=8)
    with monkeypatch.context() as m:
        def stopping(*args):
            raise InterruptedError
        m.setattr(S, stop, stopping)
        with pytest.raises(InterruptedError):
            S.check_load(spark, two, CHECKS, path, "two", buckets=8)
    if stop == "key_states":  # its keys are not there yet, so the load itself is repeated
        S.check_load(spark, two, CHECKS, path, "two", buckets=8)
    S.check_load(spark, three, CHECKS, path, "three", buckets=8)
    assert rows(S.merged_checks(spark, path, CHECKS)) == whole(spark, [one, two, three], rows)


def test_other_buckets_are_not_written_again(spark, tmp_path):
    path = str(tmp_path / "states")
    many = spark.range(1000).selectExpr("id", "id AS k", "'a' AS v", "1.0D AS n")
    assert S.check_load(spark, {"child": many}, CHECKS, path, "first") == set(range(S.BUCKETS))

    def files():
        return {f.relative_to(tmp_path) for f in (tmp_path / "states" / "found").rglob("part-*")}

    before = files()
    touched = S.check_load(spark, {"child": many.filter("id = 7")}, CHECKS, path, "second")
    assert 0 < len(touched) <= 2  # of one id and one reference
    changed = {f.parent.name for f in before ^ files()}
    assert changed == {f"bucket={b}" for b in touched}
    got = {(r.table_name, r.check_name): r.violations for r in S.merged_checks(spark, path, CHECKS).collect()}
    assert got["child", "unique_id"] == 1 and got["child", "relationships_k"] == 1001


def test_empty_loads(spark, tmp_path, rows):
    path = str(tmp_path / "states")
    none = {"child": spark.createDataFrame([], CHILD), "parent": spark.createDataFrame([], PARENT)}
    assert S.check_load(spark, none, CHECKS, path, "none") == set()
    assert rows(S.merged_checks(spark, path, CHECKS)) == whole(spark, [], rows)
    assert S.check_load(spark, {}, CHECKS, path, "nothing") == set()
