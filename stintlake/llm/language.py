"""Language of a text by interpolated Kneser-Ney character models, one for each language.

A model predicts the characters of a word and its end from up to ``ORDER - 1`` characters before
them in the word. Its n-grams lie in a sorted array of hashes beside their interpolated
log-probabilities, its contexts in another beside their back-off weights. The language with
the lowest cross-entropy per character is chosen; a text is accepted if that entropy and the
confidence lie within limits learned from labelled texts that the models have not seen.
"""

from __future__ import annotations

import re
import sys
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlake.llm.common import mix64, stage

ORDER = 4
#: Labelled texts per language that a model is fitted on, and that the limits are learned from.
FIT_TEXTS = 2000
CALIBRATION_TEXTS = 400
#: Share of right calibration texts that the entropy limit accepts.
ACCEPTED = 0.999
UNKNOWN = "und"
#: Words whose scores a worker keeps.
MEMO = 400_000

#: Signs for numbers, such as fractions and Roman numerals, which count as word characters elsewhere.
_NUMBERS = "".join(
    c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not (c.isalpha() or c.isdecimal())
)
_LETTERS = re.compile(rf"[^\W\d_{re.escape(_NUMBERS)}]+")
_START, _END = "\x02", "\x03"
_K = np.uint64(0x9E3779B97F4A7C15)


def letters(text: str) -> list[str]:
    """The runs of letters of a text, in lower case."""
    return _LETTERS.findall(text.lower())


def _grams(word: str) -> Iterator[str]:
    """For each predicted character, the longest n-gram that ends there."""
    padded = _START + word + _END
    for i in range(1, len(padded)):
        yield padded[max(0, i - ORDER + 1):i + 1]


def hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` codes that end at each place; places before are not meaningful."""
    h = np.zeros(len(codes), np.uint64)
    for back in range(order - 1, -1, -1):
        shifted = np.concatenate([np.zeros(back, np.uint64), codes])[:len(codes)]
        h = (h + shifted + np.uint64(1)) * _K
    return mix64(h ^ np.uint64(order))


def _hash_text(grams: list[str]) -> np.ndarray:
    """Hashes of n-grams given as text."""
    out = np.zeros(len(grams), np.uint64)
    by_length = defaultdict(list)
    for i, g in enumerate(grams):
        by_length[len(g)].append(i)
    for n, places in by_length.items():
        if n == 0:
            continue
        joined = "".join(grams[i] for i in places)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        out[places] = hashes(codes, n)[n - 1::n]
    return out


@dataclass
class CharacterModel:
    """Interpolated Kneser-Ney probabilities of one language in sorted hash arrays."""

    grams: np.ndarray
    log_p: np.ndarray
    contexts: np.ndarray
    log_backoff: np.ndarray
    log_floor: float

    @staticmethod
    def fit(counts: dict[str, int], alphabet: int) -> CharacterModel:
        """From the counts of the longest n-grams; shorter ones count their distinct extensions."""
        levels: dict[int, dict[str, int]] = {n: {} for n in range(1, ORDER + 1)}
        for gram, n in counts.items():
            levels[len(gram)][gram] = n
        for n in range(ORDER - 1, 0, -1):
            more = Counter(gram[1:] for gram in levels[n + 1])
            for gram, extensions in more.items():
                levels[n][gram] = extensions
        p: dict[str, float] = {}
        backoff: dict[str, float] = {}
        floor = 1.0 / (alphabet + 1)
        for n in range(1, ORDER + 1):
            grams = levels[n]
            values = Counter(grams.values())
            discount = values[1] / (values[1] + 2 * values[2]) if values[1] else 0.5
            discount = min(max(discount, 0.1), 0.9)
            total, kinds = Counter(), Counter()
            for gram, c in grams.items():
                total[gram[:-1]] += c
                kinds[gram[:-1]] += 1
            for context, c in total.items():
                backoff[context] = discount * kinds[context] / c
            for gram, c in grams.items():
                lower = p.get(gram[1:], floor) if n > 1 else floor
                context = gram[:-1]
                p[gram] = max(c - discount, 0) / total[context] + backoff[context] * lower
        return CharacterModel(
            *_sorted(p), *_sorted(backoff), float(np.log(floor)),
        )

    def _find(self, keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, keys), max(0, len(table) - 1))
        return at, (table[at] == keys) if len(table) else np.zeros(len(keys), bool)

    def score(self, keys: list[np.ndarray], depth: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Log-probability of the character at each wanted place; 0 elsewhere.

        ``keys[n]`` has the hash of the n codes that end there, ``depth`` how many there are
        from the start of the word.
        """
        out = np.zeros(len(depth))
        left = np.flatnonzero(wanted)
        for n in range(ORDER, 0, -1):
            now = left[depth[left] >= n]
            rest = left[depth[left] < n]
            at, known = self._find(keys[n][now], self.grams)
            out[now[known]] += self.log_p[at[known]]
            now = now[~known]
            context = keys[n - 1][now - 1] if n > 1 else np.full(len(now), keys[0][0])
            at, known = self._find(context, self.contexts)
            out[now[known]] += self.log_backoff[at[known]]
            left = np.sort(np.concatenate([rest, now]))
        out[left] += self.log_floor
        return out


def _sorted(values: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    keys = _hash_text(list(values))
    order = np.argsort(keys)
    return keys[order], np.log(np.array(list(values.values()), float))[order].astype(np.float32)


@dataclass
class Identifier:
    """The models of all learned languages, and the learned limits."""

    languages: list[str]
    models: list[CharacterModel]
    temperature: float = 1.0
    limits: list[float] = field(default_factory=list)
    least_score: float = 0.0

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Per chunk of text: a log-probability for each language, and the characters scored."""
        runs = [letters(w) for w in words]
        text = "".join(_START + run + _END for chunk in runs for run in chunk)
        out = np.zeros((len(words), len(self.models) + 1))
        if not text:
            return out
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        starts = codes == ord(_START)
        index = np.arange(len(codes))
        depth = index - np.maximum.accumulate(np.where(starts, index, 0)) + 1
        sizes = [sum(len(run) + 2 for run in chunk) for chunk in runs]
        owner = np.repeat(np.arange(len(words)), sizes)
        keys = [_hash_text([""])] + [hashes(codes, n) for n in range(1, ORDER + 1)]
        for k, model in enumerate(self.models):
            out[:, k] = np.bincount(owner, model.score(keys, depth, ~starts), len(words))
        out[:, -1] = np.bincount(owner, ~starts, len(words))
        return out

    def decide(self, totals: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, confidence, entropy and acceptance from the summed word scores."""
        size = totals[:, -1]
        entropy = -totals[:, :-1] / np.maximum(size, 1)[:, None]
        best = entropy.argmin(axis=1)
        lowest = entropy[np.arange(len(best)), best]
        weight = np.exp((lowest[:, None] - entropy) * np.sqrt(size)[:, None] / self.temperature)
        score = np.where(size > 0, 1.0 / weight.sum(axis=1), 0.0)
        names = [self.languages[b] if n else UNKNOWN for b, n in zip(best, size)]
        limit = np.array(self.limits)[best] if self.limits else np.full(len(best), np.inf)
        return names, score, lowest, (size > 0) & (lowest <= limit) & (score >= self.least_score)


class _Memo(dict):
    def __init__(self):
        super().__init__()
        self.table = np.zeros((1024, 0))


def _totals(identifier: Identifier, memo: _Memo, texts: list[str | None]) -> np.ndarray:
    """Summed word scores of each text; words not met before are scored together."""
    chunks = [t.split() if t else [] for t in texts]
    if len(memo) > MEMO:
        memo.clear()
    new = list({w for chunk in chunks for w in chunk if w not in memo})
    width = len(identifier.models) + 1
    if memo.table.shape[1] != width or not memo:
        memo.table = np.zeros((1024, width))
    need = len(memo) + len(new)
    if need > len(memo.table):
        grown = np.zeros((2 * need, width))
        grown[:len(memo)] = memo.table[:len(memo)]
        memo.table = grown
    memo.table[len(memo):need] = identifier.word_scores(new)
    memo.update(zip(new, range(len(memo), need)))
    out = np.zeros((len(texts), width))
    for i, chunk in enumerate(chunks):
        if chunk:
            out[i] = memo.table[np.fromiter(map(memo.__getitem__, chunk), np.int64, len(chunk))].sum(0)
    return out


def _sample(labelled: DataFrame, texts: int) -> DataFrame:
    """About ``texts`` rows of each language, chosen by a hash of the id; all if there are fewer."""
    sizes = labelled.groupBy("lang").count().collect()  # one row per language
    chance = F.lit(0.0)
    for r in sizes:
        chance = F.when(F.col("lang") == r["lang"], min(1.0, texts / r["count"])).otherwise(chance)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) / float(1 << 20)
    return labelled.filter(draw < chance)


def fit(
    labelled: DataFrame, *, fit_texts: int = FIT_TEXTS, calibration_texts: int = CALIBRATION_TEXTS
) -> Identifier:
    """Learn from ``labelled(doc_id, text, lang)``; rows without a language are left out.

    ``fit_texts`` and ``calibration_texts`` bound the labelled texts per language; whole texts
    of that sample are counted on Spark, and the driver gets the n-gram counts, which an
    alphabet and a sample bound. An empty table learns no language; every text is then ``und``.
    """
    total = fit_texts + calibration_texts
    sample = stage(
        _sample(labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang"), total)
        .withColumn("calibrates", F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(total)) < calibration_texts),
        "labelled",
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words[lang].update(letters(text))
        for lang, found in words.items():
            grams = Counter()
            for word, n in found.items():
                for gram in _grams(word):
                    grams[gram] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(list(grams), pa.string()),
                 pa.array(list(grams.values()), pa.int64())], ["lang", "gram", "n"],
            )

    def counted() -> pd.DataFrame:
        return (
            sample.filter("not calibrates").select("text", "lang")
            .mapInArrow(count, "lang string, gram string, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
        )

    rows = counted()
    # a rare language may have all its texts set aside; they are fitted on instead
    lost = {r.lang for r in sample.filter("calibrates").select("lang").distinct().collect()} - set(rows.lang)
    if lost:
        sample = sample.withColumn("calibrates", F.col("calibrates") & ~F.col("lang").isin(*lost))
        rows = counted()
    counts = {lang: dict(zip(part.gram, part.n)) for lang, part in rows.groupby("lang")}
    alphabet = len({c for grams in counts.values() for g in grams for c in g})
    names = sorted(counts)
    models = [CharacterModel.fit(counts[n], alphabet) for n in names]
    return _calibrate(Identifier(names, models), sample.filter("calibrates"))


def _calibrate(identifier: Identifier, sample: DataFrame) -> Identifier:
    """Learn the temperature of the confidence and the limits of acceptance."""
    if not identifier.models:
        return identifier
    width = len(identifier.models) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Memo()
        for batch in batches:
            totals = _totals(identifier, memo, batch.column(0).to_pylist())
            lists = pa.ListArray.from_arrays(
                np.arange(0, totals.size + 1, width, dtype=np.int32), pa.array(totals.ravel())
            )
            yield pa.RecordBatch.from_arrays([batch.column(1), lists], ["lang", "totals"])

    rows = sample.select("text", "lang").mapInArrow(run, "lang string, totals array<double>").collect()
    rows = [r for r in rows if r.lang in identifier.languages and r.totals[-1] > 0]
    if not rows:
        return identifier
    totals = np.array([r.totals for r in rows])
    truth = np.array([identifier.languages.index(r.lang) for r in rows])
    size = totals[:, -1]
    entropy = -totals[:, :-1] / size[:, None]
    logits = -entropy * np.sqrt(size)[:, None]

    def loss(t: float) -> float:
        z = logits / t
        z -= z.max(axis=1, keepdims=True)
        own = z[np.arange(len(z)), truth] - np.log(np.exp(z).sum(axis=1))
        return -float(own.mean())

    identifier.temperature = float(min(np.geomspace(0.1, 20, 60), key=loss))
    best = entropy.argmin(axis=1)
    right = best == truth
    lowest = entropy.min(axis=1)
    identifier.limits = [
        float(np.quantile(lowest[right & (best == k)], ACCEPTED)) * 1.1
        if (right & (best == k)).any() else float("inf")
        for k in range(len(identifier.languages))
    ]
    _, score, _, _ = identifier.decide(totals)
    identifier.least_score = float(np.quantile(score[right], 1 - ACCEPTED)) if right.any() else 0.0
    return identifier


def identify(docs: DataFrame, identifier: Identifier) -> DataFrame:
    """All rows and columns of ``docs`` with lang_pred, score, entropy and accepted.

    ``lang_pred`` is the learned language with the lowest entropy per character, or ``und`` for
    a NULL text and a text without letters; ``score`` its calibrated confidence. ``accepted``
    is false where text or margin is unlike the learned languages. Input columns of these
    names are replaced. Equal texts get equal results; very long texts are scored whole.
    """
    added = ("lang_pred", "score", "entropy", "accepted")
    names = [c for c in docs.columns if c not in added]
    at = names.index("text")
    given = docs.select(*names)
    kinds = (T.StringType(), T.DoubleType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([*given.schema.fields, *map(T.StructField, added, kinds)])
    shared = docs.sparkSession.sparkContext.broadcast(identifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Memo()
        for batch in batches:
            n = batch.num_rows
            if shared.value.models:
                parts = [
                    _totals(shared.value, memo, batch.column(at).slice(i, 500).to_pylist())
                    for i in range(0, n, 500)
                ]
                lang, score, entropy, accepted = shared.value.decide(np.concatenate(parts))
            else:
                lang, score, entropy, accepted = [UNKNOWN] * n, *np.zeros((2, n)), np.zeros(n, bool)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(entropy),
                 pa.array(accepted)], [*names, *added],
            )

    return given.mapInArrow(run, schema)
