import math

import numpy as np
import pytest

from stintlake.llm import language as L
from stintlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_rows(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = QUERIES["op2_language"](spark, SF).collect()
    held = [r for r in out if r.held_out]
    right = sum(r.lang_pred == truth[r.doc_id] for r in held)
    assert len(out) == len(truth) and right >= 0.98 * len(held)
    assert sum(r.accepted for r in out) >= 0.9 * len(out) and all(0 <= r.score <= 1 for r in out)


def probability(model, context, c):
    codes = np.array([ord(x) for x in context + c], np.uint64)
    keys = [L._hash_text([""])] + [L.hashes(codes, n) for n in range(1, L.ORDER + 1)]
    last = np.arange(len(codes)) == len(codes) - 1
    return math.exp(model.score(keys, np.arange(1, len(codes) + 1), last)[-1])


@pytest.mark.parametrize("context", ["", "a", "ab", "bab", "zz", "c"])
def test_probabilities_of_a_context_add_up_to_one(context):
    counts = {}
    for w in "abba baba abab cab bac ab a".split():
        for g in L._grams(w):
            counts[g] = counts.get(g, 0) + 1
    alphabet = {c for g in counts for c in g}
    model = L.CharacterModel.fit(counts, len(alphabet))
    total = sum(probability(model, L._START + context, c) for c in [*alphabet, "\u2603"])
    assert abs(total - 1) < 1e-4


@pytest.fixture
def known(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate(
        [("the cat sat on the mat with the hat", "en"), ("le chat est sur la table avec une", "fr")] * 40
    )]
    return L.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), fit_texts=60, calibration_texts=20)


def test_odd_rows(spark, docs, known):
    df = docs("The cat!", "une table", None, "", "123 !?", "x" * 200_000, "the mat " * 50_000, "the cat", "the cat")
    out = {r.doc_id: r for r in L.identify(df.withColumnRenamed("lang", "score"), known).collect()}
    assert [out[i].lang_pred for i in range(5)] == ["en", "fr", "und", "und", "und"]
    assert not any(out[i].accepted for i in (2, 3, 4)) and out[6].lang_pred == "en"
    assert out[7].score == out[8].score and not out[5].accepted
    assert L.identify(docs(), known).count() == 0


def test_nothing_learned(docs):
    empty = L.fit(docs())
    assert [r.lang_pred for r in L.identify(docs("a", None), empty).collect()] == ["und", "und"]


def test_rare_languages_keep_their_texts_for_fitting(spark):
    rows = [(i, "the cat sat on the mat and the dog ran", "en") for i in range(30)]
    rows += [(100 + i, f"slowo {'qxz' * (i + 1)} zolw", f"rare{i}") for i in range(40)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(L.fit(labelled).languages) == {r[2] for r in rows}


def test_letters_are_letters_only(docs, known):
    out = L.identify(docs("\u00bd", "\u00b2 \u2460", "\u2167", "42 _"), known).collect()
    assert {r.lang_pred for r in out} == {"und"} and not any(r.accepted for r in out)
    assert all(L._LETTERS.fullmatch(c) is not None for c in "a\u00e9\u4e00\u0434\u02b0")
    assert all((L._LETTERS.fullmatch(chr(c)) is not None) == chr(c).isalpha() for c in range(0x3000))
