import numpy as np
import pytest

from stintlake.llm import quality as Q
from stintlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out = QUERIES["op10_quality"](spark, SF).collect()
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in out if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    assert right >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in out)


def test_fit_equals_direct_formula(spark, docs):
    texts = [f"some words here {'x' * (i % 7)} {i} and {'y!' * (i % 5)}." for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    model = Q.fit(docs(*texts), labels, pooled=0.3, diagonal=0.05)
    x = np.array([Q.statistics(t.encode()) for t in texts])
    y = np.arange(40) % 2
    z = (x - x.mean(0)) / np.sqrt(np.maximum(x.var(0), 1e-6))
    within = sum(np.cov(z[y == k].T, bias=True) / 2 for k in (0, 1))
    log = []
    for k in (0, 1):
        c = 0.7 * np.cov(z[y == k].T, bias=True) + 0.3 * within
        c = 0.95 * c + 0.05 * np.diag(np.diag(c)) + 1e-3 * np.eye(len(c))
        d = z - z[y == k].mean(0)
        log.append(-0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d))
    expected = 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))
    got = [r.score for r in Q.score(docs(*texts), model).orderBy("doc_id").collect()]
    assert np.allclose(got, expected, atol=1e-5)


def test_odd_rows(spark, docs):
    labels = spark.createDataFrame(
        [(0, 1), (0, 1), (1, 0), (1, 1), (2, 0), (None, 1), (3, None)], "doc_id bigint, quality int"
    )
    df = docs("fine text", "contradicting", "BAD!! " * 50, None, "", (None, "x"), (0, "repeated"), "z" * 300_000)
    model = Q.fit(df, labels)
    out = Q.score(df.withColumnRenamed("lang", "score"), model)
    assert out.columns == ["doc_id", "text", "source", "n_chars", "score"] and out.count() == 8
    assert all(0 <= r.score <= 1 for r in out.collect())
    assert Q.score(docs(), model).count() == 0
    assert Q.keep_good(df, model).columns == df.columns


@pytest.mark.parametrize("present", [[], [0], [1]])
def test_missing_classes(spark, docs, present):
    labels = spark.createDataFrame([(i, k) for i, k in enumerate(present)], "doc_id bigint, quality int")
    out = Q.score(docs("a", "b"), Q.fit(docs("a", "b"), labels)).collect()
    assert all(0 <= r.score <= 1 for r in out)
