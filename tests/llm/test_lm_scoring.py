import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stintlake.llm import lm_scoring as M
from stintlake.llm import succinct as S
from stintlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*low.encode().split(), None]


class Plain:
    """The same model from dictionaries, without codes."""

    def __init__(self, texts, least=2, discount=0.75):
        self.one, self.two, self.three = Counter(), Counter(), Counter()
        for text in texts:
            t = tokens(text)
            self.one.update(t)
            t = ["start", *t]
            self.two.update(zip(t, t[1:]))
            self.three.update(zip(t, t[1:], t[2:]))
        self.texts, self.d = len(texts), discount
        self.n, self.v = sum(self.one.values()), len(self.one)
        self.two = {k: c for k, c in self.two.items() if c >= least}
        self.three = {
            k: c for k, c in self.three.items() if c >= least and k[:2] in self.two and k[1:] in self.two
        }
        self.mass = Counter()
        for k, c in [*self.two.items(), *self.three.items()]:
            self.mass[k[:-1]] += c - discount

    def p1(self, w):
        return (self.one[w] + 0.1) / (self.n + 0.1 * (self.v + 1))

    def p2(self, v, w):
        total = self.texts if v == "start" else self.one[v]
        if total < 2 and v != "start":
            return self.p1(w)
        c = self.two.get((v, w), 0)
        return max(c - self.d, 0) / max(total, 1) + (1 - self.mass[(v,)] / max(total, 1)) * self.p1(w)

    def p3(self, u, v, w):
        total = self.two.get((u, v), 0)
        if not total:
            return self.p2(v, w)
        c = self.three.get((u, v, w), 0)
        return max(c - self.d, 0) / total + (1 - self.mass[(u, v)] / total) * self.p2(v, w)

    def score(self, text):
        t = ["start", *tokens(text)]
        out = math.log10(self.p2(t[0], t[1]))
        return out + sum(math.log10(self.p3(*x)) for x in zip(t, t[1:], t[2:]))

    def base(self, text):
        return sum(math.log10(self.p1(w)) for w in tokens(text))


def compare(rows, train, score_of):
    plain = Plain(train)
    for r in rows:
        text = score_of[r.doc_id]
        t = tokens(text)
        assert r.n_tokens == len(t) and r.n_known == sum(plain.one[w] > 0 for w in t)
        assert r.train_tokens == plain.n
        assert math.isclose(r.base_score, plain.base(text), rel_tol=1e-9)
        assert abs(r.score - plain.score(text)) <= 0.02 * len(t) + 0.05


def test_query_on_given_table(spark):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 10 == 0}
    out = QUERIES["op9_lm_scoring"](spark, SF).collect()
    assert {r.doc_id for r in out if r.held_out} == held and len(out) == len(texts)
    compare(out, [t for i, t in texts.items() if i not in held], texts)
    gains = [r.score - r.base_score for r in out if r.held_out]
    assert sum(gains) > 0  # contexts help on texts that were not learned from


@pytest.mark.parametrize("block_words", [3, 1000])
def test_blocks_and_odd_texts(docs, block_words):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("a b c d e A Ä".split()) for _ in range(rng.randrange(20))) for _ in range(60)]
    texts += [None, "", " ", "unseen words only", "a " * 30_000]
    train = docs(*texts[:40], None, "")
    df = docs(*texts).repartition(3).withColumnRenamed("lang", "score")
    out = M.score(df, M.train(train, block_words=block_words)).collect()
    compare(out, [*texts[:40], None, ""], dict(enumerate(texts)))


def test_levels_shrink_to_their_bound(docs):
    train = docs(*["a b c a b c a b d"] * 5, "x y x y", "p q p q r s")
    model = M.train(train, max_entries=4)
    scores = [r.score for r in M.score(docs("a b c", "x q"), model).collect()]
    assert all(math.isfinite(s) and s < 0 for s in scores)


def test_empty_tables(docs):
    model = M.train(docs())
    (row,) = M.score(docs("a b"), model).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)
    assert math.isclose(row.score, 3 * math.log10(0.1 / 0.1)) and M.score(docs(), model).count() == 0


@pytest.mark.parametrize("values", [[0], [0, 0, 0], [5, 5, 900, 901, 10**12], list(range(0, 3000, 7))])
def test_elias_fano(values, tmp_path):
    ef = S.EliasFano.build(np.array(values, np.int64))
    S.save(str(tmp_path / "f"), *S.flat([("x", ef)]))
    back = S.sequence(*S.load(str(tmp_path / "f")), "x")
    at = np.random.default_rng(1).permutation(len(values))
    assert back.get(at).tolist() == [values[i] for i in at]


@pytest.mark.parametrize("width", [1, 7, 23, 48])
def test_packed_integers(width):
    v = np.random.default_rng(width).integers(0, 1 << width, 70_001)
    packed = S.pack_bits(v, width)
    assert (S.read_bits(packed, np.arange(len(v)), width) == v).all()


def test_least_count_does_not_rise_with_the_input(docs):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(12)) for _ in range(40)]
    texts += ["one rare pair", "one rare pair"]
    df = docs(*texts)
    # far more sequences than fit one shard; those seen twice are all kept
    out = M.score(df, M.train(df, max_entries=20)).collect()
    compare(out, texts, dict(enumerate(texts)))


def test_equal_ids_are_scored_one_by_one(docs):
    model = M.train(docs("a b a b", "a b"))
    out = M.score(docs((1, "a b"), (1, "a"), (None, "a b")), model).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in out) == [(0, 3), (1, 2), (1, 3)]


def test_counts_are_deleted_before_shards_are_built(docs, monkeypatch):
    """Only frames that are still read stay on disk, and triples carry no place."""
    paths, left, places, staged, drop = {}, [], [], M.stage, M.drop_stages

    def stage(df, label="stage"):
        out = staged(df, label)
        paths[label] = os.path.dirname(out.inputFiles()[0].removeprefix("file:"))
        if label == "kept":
            places.extend(out.selectExpr("(u IS NULL) = (place IS NOT NULL)").distinct().collect())
        return out

    def dropped(*args):
        drop(*args)
        left.extend(sorted(k for k, p in paths.items() if os.path.exists(p)))

    monkeypatch.setattr(M, "stage", stage)
    monkeypatch.setattr(M, "drop_stages", dropped)
    M.train(docs("a b c d", "a b c", "b c d a b c"))
    assert left == ["pairs", "triples", "word-weights"] and places == [(True,)]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_tokens_of_a_column(kind):
    """Texts are split as columns, not word by word."""
    texts = [" a\x0bB\x0cb\r\n\ta ", None, "", " \n", "É\x85a\xa0b\x1cc Éa", "a"]
    hashes, places, sizes = M._words(pa.array(["x", *texts], kind).slice(1))
    assert (np.diff(hashes.view(np.uint64)) > 0).all() and sizes.tolist() == [len(tokens(t)) for t in texts]
    want = [M._hash(w or M._END) for t in texts for w in tokens(t)]
    assert hashes[places].tolist() == want and set(hashes.tolist()) - set(want) <= {M._hash(b"")}


def test_chunks_hold_whole_texts_and_their_rows():
    texts = ["a " * n for n in (0, 5, 200, 0, 3, 90)] + [None]
    rows = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["place", "text"])
    parts = list(M._chunks(iter([rows.slice(0, 4), rows.slice(4), rows.slice(7)]), 1, words=20))
    assert [p["place"].to_pylist() for p, _ in parts] == [[0, 1, 2], [3, 4, 5], [6]]
    assert [t for _, part in parts for t in part.to_pylist()] == texts


def test_a_level_finds_the_same_entries_decoded_or_by_halving():
    rng = np.random.default_rng(4)
    both = np.unique(rng.integers(0, 50 * 300, 2000))
    context, child = both // 300, both % 300
    level = M.Level.build(context, child, 60, 9, rng.random(len(both)))
    assert level.pointers.all().tolist() == level.pointers.get(np.arange(61)).tolist()
    for many in (3, 5000):
        c, x = rng.integers(0, 60, many), rng.integers(0, 300, many)
        at = {(a, b): i for i, (a, b) in enumerate(zip(context, child))}
        assert level.entries(c, x).tolist() == [at.get(k, -1) for k in zip(c, x)]
    assert M.Level.build(context[:0], child[:0], 4, 9, np.zeros(0)).entries(c % 4, x).max() == -1


@pytest.mark.parametrize("size", [0, 5, 3000])
def test_sent_names_are_steps_and_come_back(size):
    rng = np.random.default_rng(size)
    names = np.unique(rng.integers(2, 1 << 64, 2 * size + 2, dtype=np.uint64))
    common = names[::3]
    u, w = rng.integers(0, len(names), (2, size))
    data = M._pack(M._columns(names, M._find(common, names), u=u, w=w))
    back = M._unpack(pa.py_buffer(data), common)
    assert (back["names"][back["u"]] == names[u]).all() and (back["names"][back["w"]] == names[w]).all()
    rare = len(set(u.tolist() + w.tolist()) - set(range(0, len(names), 3)))
    columns = sum(back[c].nbytes for c in "uw")
    assert size < 3000 or len(data) < 7.5 * rare + columns + 2 * len(common)  # not eight bytes a hash
