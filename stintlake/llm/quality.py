"""Text quality by regularised quadratic discriminant analysis over document statistics.

Each class gets a Gaussian over transformed statistics. Its covariance is drawn towards the
pooled covariance and then towards its own diagonal; the Cholesky factors are computed once and
kept with the model. A score is the difference of the classes' Mahalanobis log-densities, as a
probability. Sums and cross products are added up on Spark over all labelled rows, so the
driver sees a fixed number of figures whatever the size of the table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlake.llm.common import lean, text_bytes

FEATURES = (
    "log_bytes", "upper", "digits", "marks", "sentence_marks", "word_length", "distinct",
    "commonest", "adjacent", "repeated_lines", "line_words", "glued_marks",
)
#: Added to counts of words and lines, so that shares in short texts are near 0.
SMALL = 8
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = b"0123456789"
_SENTENCE = b".,;:?'"
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in _SENTENCE)
_LETTERS_LOW = bytes(range(256)).lower()


def _angle(part: float, whole: float) -> float:
    """A share on a scale where shares near 0 and 1 are told apart."""
    return float(np.arcsin(np.sqrt(min(1.0, part / whole)))) if whole else 0.0


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one whole text, in the order of FEATURES."""
    size = len(text)
    words = text.translate(_LETTERS_LOW).split()
    n = len(words)
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    adjacent = sum(map(bytes.__eq__, words, words[1:]))
    marks = size - len(text.translate(None, _MARKS))
    glued = sum(w[-1] in _MARKS for w in counts)
    return [
        float(np.log1p(size)),
        _angle(size - len(text.translate(None, _UPPER)), size),
        _angle(size - len(text.translate(None, _DIGITS)), size),
        _angle(marks, size),
        _angle(size - len(text.translate(None, _SENTENCE)), size),
        float(np.log1p(sum(map(len, words)) / n)) if n else 0.0,
        float(np.log(len(counts) + 1.0) / np.log(n + 1.0)) if n else 0.0,
        _angle(max(counts.values(), default=0), n + SMALL),
        _angle(adjacent, n + SMALL),
        _angle(len(lines) - len(set(lines)), len(lines) + SMALL),
        float(np.log1p(n / len(lines))) if lines else 0.0,
        _angle(glued, len(counts) + SMALL),
    ]


def _matrix(column: pa.Array) -> np.ndarray:
    rows = [statistics(t) for t in text_bytes(column)]
    return np.array(rows, float).reshape(len(rows), len(FEATURES))


@dataclass
class Model:
    """Scaling, class means and the Cholesky factors of the class covariances."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_weights: list[float]
    #: log-determinant halves, from the cached factors
    halves: list[float] = field(init=False)

    def __post_init__(self):
        self.halves = [float(np.log(np.diag(f)).sum()) for f in self.factors]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        z = (x - self.centre) / self.scale
        log = []
        for mean, factor, half, weight in zip(
            self.means, self.factors, self.halves, self.log_weights
        ):
            y = np.linalg.solve(factor, (z - mean).T)
            log.append(weight - half - 0.5 * (y * y).sum(axis=0))
        return 1.0 / (1.0 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def fit(
    docs: DataFrame, labels: DataFrame, *, pooled: float = 0.3, diagonal: float = 0.05
) -> Model:
    """Fit on the rows of ``docs(doc_id, text)`` whose id has one label 0 or 1 in ``labels(doc_id, quality)``.

    Covariances are mixed with a share ``pooled`` of the pooled one and then with a share
    ``diagonal`` of their own diagonal; a floor keeps constant statistics invertible. Rows
    without an id or a label are not used; ids with contradicting labels are left out. If
    a class has no row, it takes the pooled mean, and scores follow the class weights.
    """
    p = len(FEATURES)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            flat = pa.array(x.ravel(), pa.float64())
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, p, dtype=np.int32), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "x"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + p + p * p))
        for batch in batches:
            x = np.array(batch.column(1).flatten(), float).reshape(-1, p)
            y = np.array(batch.column(0))
            for label in (0, 1):
                z = x[y == label]
                total[label] += np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).ravel()])
        label, k = np.divmod(np.arange(total.size), total.shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(label), pa.array(k), pa.array(total.ravel())], ["label", "k", "value"]
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").filter("doc_id IS NOT NULL").mapInArrow(
        lean(rows), f"doc_id {kind}, x array<double>"
    )
    known = (
        labels.filter("quality IN (0, 1)").groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .filter("quality = other").select("doc_id", F.col("quality").cast("int"))
    )
    added = (
        found.join(known, "doc_id").select("quality", "x")
        .mapInArrow(sums, "label long, k long, value double")
        .groupBy("label", "k").agg(F.sum("value").alias("value")).collect()
    )
    total = np.zeros((2, 1 + p + p * p))
    for r in added:
        total[r.label, r.k] = r.value
    return _model(total, p, pooled, diagonal)


def _model(total: np.ndarray, p: int, pooled: float, diagonal: float) -> Model:
    n = total[:, 0]
    both = total.sum(axis=0)
    count = max(both[0], 1.0)
    centre = both[1:1 + p] / count
    spread = np.diag(both[1 + p:].reshape(p, p)) / count - centre**2
    scale = np.sqrt(np.maximum(spread, 1e-6))
    means, covariances = [], []
    for row in total:
        m = row[1:1 + p] / row[0] if row[0] else centre
        second = row[1 + p:].reshape(p, p) / row[0] if row[0] else np.outer(m, m)
        means.append((m - centre) / scale)
        covariances.append((second - np.outer(m, m)) / np.outer(scale, scale))
    within = sum(k * c for k, c in zip(n, covariances)) / count
    factors = []
    for c in covariances:
        c = (1 - pooled) * c + pooled * within
        c = (1 - diagonal) * c + diagonal * np.diag(np.diag(c)) + 1e-3 * np.eye(p)
        factors.append(np.linalg.cholesky(c))
    weights = np.log((n + 1) / (count + 2))
    return Model(centre, scale, means, factors, list(map(float, weights)))


def score(docs: DataFrame, model: Model, *, column: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` and the probability of label 1 as ``column``.

    NULL and empty texts have the statistics of an empty text. An input column of that name
    is replaced.
    """
    kept = [c for c in docs.columns if c != column]
    at = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(model.scores(_matrix(batch.column(at))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], [*kept, column])

    given = docs.select(*kept)
    schema = T.StructType([*given.schema.fields, T.StructField(column, T.DoubleType())])
    return given.mapInArrow(lean(run), schema)


def keep_good(docs: DataFrame, model: Model, *, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, unchanged."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = model.scores(_matrix(batch.column(at))) >= threshold
            yield pc.filter(batch, pa.array(keep))

    return docs.mapInArrow(lean(run), docs.schema)
