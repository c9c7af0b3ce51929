import random

import numpy as np
import pytest

from stintlake.llm import components
from stintlake.llm import jaccard_join as J
from stintlake.llm.common import stage
from stintlake.llm.components import connected
from stintlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def sets_of(text, words=5):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute(rows, percent=75, words=5):
    """component_id and set size of each row, from all pairs."""
    sets = [sets_of(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {doc_id: (len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows)}


def test_query_on_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op7_jaccard_join"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(rows)
    assert len({r.component_id for r in out}) < len(out)


def chained(seed, texts, vocabulary):
    """Texts derived from each other by a few edits, so that similarity is not transitive."""
    rng = random.Random(seed)
    out = [[rng.choice(vocabulary) for _ in range(rng.randrange(1, 80))] for _ in range(6)]
    while len(out) < texts:
        new = list(rng.choice(out))
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(new) + 1)
            new[at:at + rng.randrange(2)] = [rng.choice(vocabulary)]
        out.append(new + ["common", "line", "at", "the", "end", "of", "all"] * rng.randrange(2))
    return [(1000 - i, " ".join(x)) for i, x in enumerate(out)]


@pytest.mark.parametrize("seed,salt_rows,sketch", [(1, 4096, 30_000), (2, 1, 30_000), (3, 3, 50)])
def test_chains_against_brute_force(docs, seed, salt_rows, sketch, monkeypatch):
    monkeypatch.setattr(J, "SMALL_BLOCK", 4)
    rows = chained(seed, 220, [f"w{i}" for i in range(40)])
    df = docs(*rows).repartition(3)
    out = J.jaccard_components(df, salt_rows=salt_rows, sketch_texts=sketch).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(rows)


def test_tree_join_loses_no_pair():
    rng = np.random.default_rng(4)
    base = rng.poisson(2, (12, J.GROUPS))
    points = np.maximum(0, base[rng.integers(0, 12, 900)] + rng.integers(-1, 2, (900, J.GROUPS)) * (rng.random((900, J.GROUPS)) < 0.2))
    points = points.astype("<u1")
    n = points.sum(axis=1).astype(np.int64)
    component = rng.integers(0, 40, 900)
    got = {tuple(sorted(p)) for a, b in J.tree_join(points, n, component, 75) for p in zip(a.tolist(), b.tolist())}
    for i in range(900):
        bound = np.minimum(points[i], points[:i]).sum(axis=1, dtype=np.int64)
        fits = (100 * np.minimum(n[i], n[:i]) >= 75 * np.maximum(n[i], n[:i]))
        fits &= (bound >= J.needed_overlap(n[i], n[:i], 75)) & (component[i] != component[:i])
        assert {(j, i) for j in np.flatnonzero(fits).tolist()} <= got


def test_points_bound_the_overlap():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)) for n in (1, 40, 600, 700, 9000, 9500)]
    sets += [np.unique(np.concatenate([s[: len(s) * 9 // 10], sets[1]])) for s in sets] + [np.arange(400, dtype=np.uint64)]
    points = [J._point(s) for s in sets]
    a, b = zip(*[(i, j) for i in range(len(sets)) for j in range(len(sets))])
    bound = J._overlap_bound([points[i] for i in a], [points[j] for j in b])
    for i, j, most in zip(a, b, bound):
        assert most >= len(np.intersect1d(sets[i], sets[j]))
        assert most <= min(len(sets[i]), len(sets[j]))


def test_odd_rows(docs):
    rows = [(5, "a b"), (5, "a b"), (7, "A  B"), (None, "a b"), (1, None), (2, ""), (3, " "), (4, "x" * 100_000), (None, "z")]
    out = J.jaccard_components(docs(*rows).withColumnRenamed("lang", "node")).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=repr)
    assert got == sorted([(5, 1, 5), (5, 1, 5), (7, 1, 5), (None, 1, 5), (1, 0, 1), (2, 0, 2), (3, 0, 3),
                          (4, 1, 4), (None, 1, None)], key=repr)
    kept = J.keep_one(docs(*rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted(
        [(5, "a b"), (1, None), (2, ""), (3, " "), (4, "x" * 100_000), (None, "z")], key=repr)
    assert J.jaccard_components(docs()).count() == 0 and J.keep_one(docs()).count() == 0


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 90, 95: 90, 90: 90}


def test_rounds_take_a_shuffle_and_tasks_by_the_cores(spark, monkeypatch):
    """However many partitions shuffles have, a round of a small graph is one shuffle and few tasks."""
    seen = []

    def counted(df, label):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.append((plan.count("Exchange hash"), df.rdd.getNumPartitions()))
        return stage(df, label)

    monkeypatch.setattr(components, "stage", counted)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(100, 400)] + [(5, 5), (3, 2), (2, 3)]
        got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 400)}, 1000: 100}
    most = 2 * spark.sparkContext.defaultParallelism
    assert seen and all(shuffles == 1 and tasks <= most for shuffles, tasks in seen)


def test_columns_of_any_name_are_kept(spark, docs):
    names = ["_id", "_key", "_linked", "_copies", "_text", "one", "row", "text_key", "component_id", "n_shingles"]
    text = "one two three four five six seven"
    df = docs(text, text + " eight", None, "", (0, text), "other words here").selectExpr("*", *[f"1 AS {n}" for n in names])
    out = J.keep_one(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [0, 2, 3, 5]


@pytest.mark.parametrize("texts", [30_000, 2])
def test_sketch_counts_every_text(docs, texts):
    """However few texts a task counts at a time, the sketch is of all of them."""
    rows = [(i, f"one line that all have number {i % 3}") for i in range(60)] + [(60, None), (61, "")]
    got = J.frequency_sketch(docs(*rows).repartition(4), J.WORDS, texts)
    counts = {}
    for _, text in rows:
        for h in J.shingles((text or "").encode()).tolist():
            slot = h >> (64 - J.SKETCH_BITS)
            counts[slot] = counts.get(slot, 0) + 1
    assert {int(i): int(got[i]) for i in np.flatnonzero(got)} == {k: n.bit_length() for k, n in counts.items()}
    assert not J.frequency_sketch(docs(), J.WORDS).any()


def near_copies(seed, texts, groups):
    """Texts of a few groups whose pairs lie around the threshold, most of them below it."""
    rng = random.Random(seed)
    base = [[f"g{g}w{i}" for i in range(120)] for g in range(groups)]
    rows = []
    for i in range(texts):
        new = list(base[i % groups])
        for at in rng.sample(range(120), rng.randrange(1, 6)):
            new[at] = f"x{i}y{at}"
        rows.append((i, " ".join(new)))
    return rows


def test_second_round_puts_out_no_pair_products(docs, monkeypatch):
    """What the blocks put out grows with their rows, not with the pairs of near copies."""
    rows, made = near_copies(5, 160, 2), {}
    staged = J.stage

    def stage(df, label="stage"):
        out = staged(df, label)
        made[label] = out.count()
        return out

    monkeypatch.setattr(J, "stage", stage)
    out = J.jaccard_components(docs(*rows).repartition(3)).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want
    assert 1 < len({c for _, c in want.values()}) < len(rows)
    assert 0 < made["mixed"] <= 4 * len(rows)


@pytest.mark.parametrize("seed,part", [(1, 1), (2, 3), (3, 16)])
def test_tiles_against_brute_force(docs, seed, part, monkeypatch):
    monkeypatch.setattr(J, "TILE_ROWS", part)
    monkeypatch.setattr(J, "SMALL_BLOCK", 4)
    rows = near_copies(seed, 60, 2) + [(1000 + i, t) for i, t in chained(seed, 60, [f"w{i}" for i in range(40)])]
    out = J.jaccard_components(docs(*rows).repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(rows)


@pytest.mark.parametrize("parts", [1, 2])
def test_tile_links_connect_what_is_similar(parts):
    rng = np.random.default_rng(8)
    base = np.unique(rng.integers(0, 1 << 62, 60, dtype=np.uint64))
    sets = [np.sort(rng.permutation(base)[:rng.integers(30, 55)]) for _ in range(80)]
    second = np.arange(80) % 2 == 1 if parts == 2 else np.zeros(80, bool)
    component = rng.integers(0, 70, 80)
    links = J.tile_links(np.arange(80), component, second, sets, 75)
    assert len(links) < 80

    def joined(pairs):
        label = component.copy()
        for i, j in pairs:
            label[label == label[i]] = label[j]
        return {tuple(np.flatnonzero(label == x)) for x in label}

    def similar(i, j):
        both = len(np.intersect1d(sets[i], sets[j]))
        return 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both)

    pairs = [(i, j) for i in range(80) for j in range(i) if similar(i, j) and (parts == 1 or second[i] != second[j])]
    assert set(links) <= {p for i, j in pairs for p in ((i, j), (j, i))}
    assert joined(links) == joined(pairs)
