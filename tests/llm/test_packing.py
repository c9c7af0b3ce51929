import zlib
from collections import defaultdict

import pytest

from stintlake.llm import packing
from stintlake.llm.token_ids import encode, vocabulary_path, words_of

SF = "/root/testdata/sf0.001"


def check(pieces, texts, window):
    """Every id in one piece, every sequence gapless and within the window."""
    words = words_of(vocabulary_path())
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        of_doc[p.doc_id].append(p)
        of_sequence[p.sequence_id].append(p)
        assert zlib.crc32(bytes(p.ids)) == p.ids_crc32 and len(p.ids) == 4 * p.length > 0
    assert set(of_doc) == set(texts)
    for doc_id, mine in of_doc.items():
        mine.sort(key=lambda p: p.start)
        whole = encode(words, texts[doc_id]) + b"\2\0\0\0"
        assert b"".join(bytes(p.ids) for p in mine) == whole
        assert all(p.doc_tokens == len(whole) // 4 for p in mine)
        assert [p.start for p in mine] == [sum(q.length for q in mine[:i]) for i in range(len(mine))]
    for mine in of_sequence.values():
        mine.sort(key=lambda p: p.offset)
        assert [p.offset for p in mine] == [
            sum(q.length for q in mine[:i]) for i in range(len(mine))
        ]
        assert sum(p.length for p in mine) <= window
    return {s: sum(p.length for p in mine) for s, mine in of_sequence.items()}


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    lengths = check(packing.pack_documents(docs.repartition(5)).collect(), texts, 4096)
    assert sum(n < 4096 for n in lengths.values()) <= 1  # one merge group, one partial window
    (row,) = packing.report(packing.pack_documents(docs, window=256), 256).collect()
    assert row.padding < 256 and row.tokens == sum(lengths.values())


@pytest.mark.parametrize("window,slots", [(7, 1), (16, 3), (64, 8)])
def test_small_windows(docs, window, slots):
    texts = {i: "word " * (i * 7 % 40) for i in range(60)} | {60: "long text, " * 500, 61: None, 62: ""}
    df = docs(*texts.items()).repartition(4)
    out = packing.pack_documents(df, window=window, open_windows=slots, merge_group=2)
    lengths = check(out.collect(), texts, window)
    assert sum(n < window for n in lengths.values()) <= 2


def test_empty_and_odd_rows(spark, docs):
    assert packing.pack_documents(docs()).count() == 0
    rows = docs((None, "a b"), (None, "a b"), (3, "x"), (3, "x")).withColumnRenamed("lang", "ids")
    out = packing.pack_documents(rows).collect()
    assert sorted((p.doc_id is None, p.length) for p in out) == [
        (False, 2), (False, 2), (True, 3), (True, 3)
    ]
