import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stintlake.llm import range_coder as R
from stintlake.llm import token_files as F
from stintlake.llm.queries import QUERIES
from stintlake.llm.token_ids import vocabulary_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def test_query_on_given_table(spark, tokenizer):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    out = sorted(QUERIES["op1_token_files"](spark, SF).collect())
    assert [r.doc_id for r in out] == sorted(texts)
    start = 0
    for r in out:
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_segments_and_odd_rows(spark, docs, tokenizer, tmp_path):
    texts = [(9, "b"), (2, None), (2, ""), (None, "x y"), (1, "word " * 9000), (1, "<|endoftext|> é ß")] * 2
    F.write_token_files(docs(*texts).repartition(3), str(tmp_path / "t"), segment_ids=50)
    out = F.read_token_files(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [r.doc_id for r in out] == [None] * 2 + [1] * 4 + [2] * 4 + [9] * 2
    assert [r.start for r in out] == [sum(q.n_tokens for q in out[:i]) for i in range(len(out))]
    want = sorted(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes() for _, t in texts)
    assert sorted(bytes(r.ids) for r in out) == want
    F.write_token_files(docs(), str(tmp_path / "e"))
    assert F.read_token_files(spark, str(tmp_path / "e")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=300), st.integers(1, 64), st.sampled_from([1, 977, 35_000_000]))
def test_round_trip(ids, block, spread):
    ids = np.array(ids, np.int64) * spread
    assert (R.decode(R.encode(ids, block)) == ids).all()


@pytest.mark.parametrize("kind", ["one", "cycle", "random", "all", "skewed"])
def test_round_trip_of_full_blocks(kind):
    rng = np.random.default_rng(3)
    n = 3 * R.BLOCK + 17
    ids = {
        "one": np.full(n, 49407), "cycle": np.arange(n) % 11, "random": rng.integers(0, 49408, n),
        "all": np.arange(n), "skewed": (rng.pareto(0.7, n) * 3).astype(np.int64) % 49408,
    }[kind]
    coded = R.encode(ids)
    assert (R.decode(coded) == ids).all()
    bits = 8 * (len(coded.packed) + len(coded.differences)) / n
    assert bits < {"one": 0.2, "cycle": 0.2, "random": 23, "all": 23, "skewed": 10}[kind]


def test_blocks_stand_alone_and_damage_is_found():
    ids = np.random.default_rng(1).integers(0, 500, 5000)
    whole, first = R.encode(ids), R.encode(ids[:R.BLOCK])
    assert whole.words[0] == first.words[0] and whole.checksums[0] == first.checksums[0]
    payload = bytearray(F.pack_segment([1], [5000], ids))
    for at in (3, 60, len(payload) // 2, len(payload) - 40):
        bad = bytearray(payload)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            F.unpack_segment(bytes(bad))
    assert F.unpack_segment(bytes(payload))[2].tolist() == ids.tolist()
