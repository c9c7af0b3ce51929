import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from stintlake.llm import collocations as C
from stintlake.llm import tries

DOCS = "doc_id bigint, text string, lang string"


def brute(rows, max_words=3, least=10, top=2000):
    """Every phrase of every piece, counted in plain dictionaries."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    frequent = {k: v for k, v in f.items() if v >= least}
    out = []
    for (lang, p), a in frequent.items():
        if len(p) == 1:
            continue
        longer = [v for (other, q), v in frequent.items() if other == lang and len(q) > len(p)
                  and any(q[i:i + len(p)] == p for i in range(len(q)))]
        if any(100 * v >= 50 * a for v in longer):
            continue
        score, _, left, right = min(
            (10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
            for k in range(1, len(p))
        )
        out.append((lang, -score, -a, " ".join(p).encode(), left, right))
    ranked, seen = set(), Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.add((lang, seen[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return ranked


@pytest.fixture
def talk():
    dice = random.Random(4)
    words = ["The", "a", "São", "новый", "x-y", "b\x01", "b", "ab", " ", "'s"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! ", "\x0b"]
    rows = []
    for i in range(300):
        text = "".join(dice.choice(words[:3] * 3 + words) + dice.choice(ends[:3] * 3 + ends) for _ in range(dice.randint(0, 60)))
        rows.append((i, text, dice.choice(["en", "en", "pt", None, "", "und", "e"])))
    return rows + [(500, None, "en"), (501, "", None), (502, " . , ", "en"), (502, "rare", "one")]


@pytest.mark.parametrize("block, stretch, trie_bytes, words", [
    (500_000, 4 << 20, 2 << 30, 3), (3, 64, 2 << 30, 4), (5, 300, 1, 3),
])
def test_every_phrase(spark, talk, monkeypatch, block, stretch, trie_bytes, words):
    """With whole tries, with tries and stretches of a few phrases, and with tries sent file by file."""
    monkeypatch.setattr(C, "BLOCK", block)
    monkeypatch.setattr(C, "STRETCH", stretch)
    monkeypatch.setattr(C, "NOTES", 40 if block < 10 else C.NOTES)
    df = spark.createDataFrame(talk, DOCS).selectExpr("*", "1 AS phrase", "2 AS a", "3 AS id").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(block > 10).lower())
    try:
        found = {tuple(r) for r in C.collocations(df, max_words=words, top=30, trie_bytes=trie_bytes).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == brute([r[2:0:-1] for r in talk], words, top=30) and len(found) > 50
    assert any(" " in r[2].replace(" ", "", 1) for r in found)


def test_empty_tables_and_tables_without_phrases(spark):
    for rows in ([], [(1, "a b c", "en")], [(1, None, None)], [(1, "w. " * 20, "en")]):
        assert C.collocations(spark.createDataFrame(rows, DOCS)).count() == 0


def test_very_long_texts_and_counts_beyond_64_bits(spark):
    text = "one two. " * 200_000 + "x" * 300_000 + " end"
    rows = C.collocations(spark.createDataFrame([(1, text, "en"), (1, text, "en")], DOCS)).collect()
    assert [tuple(r) for r in rows] == [("en", 1, "one two", 400_000, 400_000, 400_000, 800_004, 1_000_000)]


def test_tries_know_their_strings_only():
    dice = random.Random(0)
    for n in (1, 2, 60, 2000):
        own = sorted({bytes(dice.choice(b"abcz\xff\x01 ") for _ in range(dice.randint(1, 9))) + b"\n" for _ in range(n)})
        base, check = tries.build(
            np.frombuffer(b"".join(own), np.uint8), np.cumsum([0, *map(len, own)])
        )

        def number(x):
            state = 0
            for letter in x:
                onward = int(base[state]) + letter
                if check[onward] != state:
                    return None
                state = onward
            return int(base[state])

        assert [number(x) for x in own] == list(range(len(own)))
        for _ in range(500):
            x = bytes(dice.choice(b"abcz\xff\x01 ") for _ in range(dice.randint(1, 6))) + b"\n"
            assert number(x) == (own.index(x) if x in own else None)


def test_words_of_a_stretch_take_little_memory():
    """Arrays with an entry for each byte of the texts are of small types."""
    group = [("en", b"abcdefghijklmnopqrstuvwxyz " * 4000 + b"end. And more")] * 8
    size = sum(len(t) for _, t in group)
    tracemalloc.start()
    words = C.Words(group)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(words.starts) == 8 * 4003 and int(words.linked.sum()) == 8 * 4001
    assert peak < 16 * size
