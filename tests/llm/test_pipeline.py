import random

import corpus_pipeline as P
from stintlake.llm import decontamination
from stintlake.llm.token_ids import encode, vocabulary_path, words_of
from tests.llm.test_decontamination import brute as brute_hits
from tests.llm.test_jaccard_join import brute as brute_components

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage on what the stage before it kept, beside plain versions of its rule."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    states = [docs]
    for i, (_, apply) in enumerate(P.STAGES):
        apply(spark, states[-1], SF).write.parquet(str(tmp_path / str(i)))
        states.append(spark.read.parquet(str(tmp_path / str(i))))
        assert states[-1].columns == columns or i == len(P.STAGES) - 1
    rows = [{r.doc_id: r.text for r in s.collect()} for s in states[:5]]
    given, good, unique, single, clean = rows

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(given[i] == t for i, t in good.items())
    wrong = [i for i, q in labels.items() if i in given and (i in good) != (q == 1)]
    assert len(wrong) <= 0.05 * len(labels)

    largest = {}
    for i, t in good.items():
        key = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        largest[key] = max(i, largest.get(key, i))
    assert set(unique) == set(largest.values())

    assert set(single) == {c for _, c in brute_components(list(unique.items())).values()}

    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    for i, t in single.items():
        hit, _ = brute_hits(t, bench, 10)
        if not any(hit):
            assert clean[i] == t
        elif i in clean:
            assert not any(brute_hits(clean[i], bench, 10)[0])
            assert len(clean[i].split()) >= len(t.split()) - sum(hit) - 1
        else:
            assert sum(hit) > decontamination.MAX_COVERAGE * len(hit)

    words = words_of(vocabulary_path())
    pieces = states[5].collect()
    for i, t in clean.items():
        mine = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in mine) == encode(words, t) + b"\2\0\0\0"
    assert {p.doc_id for p in pieces} == set(clean)


def test_run_gives_the_last_stage(spark):
    out = P.run(spark, SF)
    assert out.agg({"length": "sum"}).first()[0] > 0
    assert len(P.STAGES) == 5 and P.ORACLE_SQL is None


def test_odd_tables(spark, docs, tmp_path):
    """Nulls, empty and repeated rows, and no rows at all, pass through every stage."""
    random.seed(3)
    plain = [" ".join(random.choices(["some", "plain", "words", "of", "text"], k=30)) for _ in range(20)]
    folder = str(tmp_path / "t")
    spark.createDataFrame([(i, i % 5 and 1) for i in range(20)], "doc_id bigint, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    tables = [docs(*plain, None, "", (3, plain[3]), (None, "x y"), (None, "x y")), docs()]
    for i, state in enumerate(tables):
        for j, (_, apply) in enumerate(P.STAGES):
            apply(spark, state, folder).write.parquet(f"{folder}/{i}-{j}")
            state = spark.read.parquet(f"{folder}/{i}-{j}")
        assert state.count() > 0 if i == 0 else state.count() == 0
