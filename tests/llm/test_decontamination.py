import hashlib
import random
import re

import pytest

from stintlake.llm import decontamination as D
from stintlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window):
    """Hit flags of every word, and the items found, by comparing every place."""
    ws = words(text)
    hit, found = [False] * len(ws), set()
    for name, item in items:
        it = words(item)
        if not it:
            continue
        k = min(window, len(it))
        wanted = {tuple(it[i:i + k]) for i in range(len(it) - k + 1)}
        for i in range(len(ws) - k + 1):
            if tuple(ws[i:i + k]) in wanted:
                found.add(str(name))
                hit[i:i + k] = [True] * k
    return hit, found


@pytest.fixture
def items(spark):
    return lambda *rows: spark.createDataFrame(list(rows), "item_id bigint, text string")


def test_query_on_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: r for r in QUERIES["op3_decontamination"](spark, SF).collect()}
    assert len(got) == len(docs)
    assert any(r.contaminated for r in got.values())
    for doc_id, text in docs:
        hit, found = brute(text, bench, 10)
        r = got[doc_id]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (
            len(hit), sum(hit), len(found), digest, any(hit)
        )


@pytest.mark.parametrize("block_words", [8, 20, 1000])
def test_random_words_against_brute_force(docs, items, block_words):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice("ab") + rng.choice("cd") for _ in range(n))
    bench = [(i, say(rng.choice([1, 2, 3, 4, 6, 15]) + 1)) for i in range(6)] + [(9, None), (10, " ,"), (3, say(40))]
    texts = [say(rng.randrange(60)) for _ in range(60)] + [None, "", "- -"]
    for window in (3, 4):
        out = D.find_matches(docs(*texts), items(*bench), window=window, block_words=block_words)
        for r in out.collect():
            hit, found = brute(r.text, bench, window)
            spans = {p for s in r.hit_spans for p in range(s["first"], s["last"] + 1)}
            assert spans == {i for i, h in enumerate(hit) if h}
            assert set(r.hit_items) == found and r.hit_words == len(hit)


def test_cut_until_clean(docs, items):
    bench = items((1, "one two three four"), (2, "five"))
    texts = ["Keep this. ONE, two three-four! and that", "one two one two three four three four x y z w v u",
             "one two three four", None, "", "plain"]
    out = D.remove_matches(docs(*texts), bench, window=4, block_words=100)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[0] == "Keep this. ! and that" and 2 not in got
    assert words(got[1]) == list("xyzwvu") and got[3] is None and got[4] == "" and got[5] == "plain"
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_empty_tables_and_clashing_names(docs, items):
    df = docs("a b", "a b").withColumnRenamed("lang", "hit_items").withColumnRenamed("source", "item_id")
    assert [r.hit_words for r in D.find_matches(df, items()).collect()] == [2, 2]
    assert [r.hit_items for r in D.find_matches(df, items((7, "b"))).collect()] == [["7"], ["7"]]
    assert D.find_matches(docs(), items((7, "b"))).count() == 0
    assert D.remove_matches(docs("x"), items()).count() == 1


@pytest.mark.parametrize("rows", [[], [("a", None), ("b", " ")]])
def test_words_are_counted_without_an_automaton(spark, docs, rows):
    texts = ["USA", "iPhone one", "ÄB c", None, "..."]
    bench = spark.createDataFrame(rows, "item_id string, text string")
    out = D.find_matches(docs(*texts), bench).collect()
    assert {r.doc_id: r.hit_words for r in out} == {i: len(D.words_of((t or "").encode())) for i, t in enumerate(texts)}
