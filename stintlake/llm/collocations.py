"""Phrases whose words keep company more often than chance says, for each language.

Level by level: the phrases of n words that may be frequent are laid out as double-array tries and
sent to all executors, which map them. Numpy walks the words of a stretch of texts through a trie at
once, a byte at a time; the phrases found are counted by ``bincount``, and the sums of all tasks give
exact frequencies. Where two phrases found overlap in all but one word, the longer one that they make
is noted, so only phrases all of whose parts are frequent are noted. Counts of notes stop at the
least count, as no more is asked of them: those that reach it are the candidates of the next level.

Tries hold ``BLOCK`` phrases each, so they are built by many tasks. Beyond ``TRIE_BYTES`` they are
sent in groups, and texts are read once for each pair of groups.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stintlake.llm import tries
from stintlake.llm.common import LOWER, stage, text_bytes
from stintlake.llm.mapped import MappedTable, files_of, send
from stintlake.operators.grouping import join_same
from stintlake.session import fresh_path

MIN_COUNT, MAX_WORDS, TOP, COVERED = 10, 3, 2000, 50
UNKNOWN = "und"
#: Phrases in a trie, and bytes of trie files that are sent to executors at a time.
BLOCK = 500_000
TRIE_BYTES = 2 << 30
#: Bytes of texts that are walked at a time, and notes that a task holds before it passes them on.
STRETCH, NOTES = 4 << 20, 4_000_000

_ENDS = b".,;:!?\n\x0b\x0c\r"
_END, _SPACE, _LANG_END = 10, 32, 0xFF
_KIND = np.zeros(256, np.uint8)  # 0 a letter of a word, 1 between words, 2 between pieces
_KIND[[32, 9]] = 1
_KIND[list(_ENDS)] = 2
_WORDS_ONLY = bytes(32 if _KIND[b] else b for b in LOWER)


def stretches(langs: list[str], texts: list[bytes], most: int) -> Iterator[list[tuple[str, bytes]]]:
    """Texts with their language, in groups of about ``most`` bytes; longer ones cut between pieces."""
    group, size = [], 0
    for lang, text in zip(langs, texts):
        at = 0
        while at < len(text):
            to = at + most
            if to < len(text):
                cut = max(text.rfind(bytes([b]), at, to) for b in _ENDS)
                if cut < 0:  # a piece of over ``most`` bytes stays whole
                    cut = min((k for b in _ENDS if (k := text.find(bytes([b]), to)) >= 0), default=len(text))
                to = cut + 1
            part = text[at:to]
            at = to
            if group and size + len(part) > most:
                yield group
                group, size = [], 0
            group.append((lang, part))
            size += len(part)
    if group:
        yield group


class Words:
    """The words of a stretch: bytes with one separator behind each word, and where they start."""

    def __init__(self, group: list[tuple[str, bytes]]):
        raw = np.frombuffer((b"\n".join(t for _, t in group) + b"\n").translate(LOWER), np.uint8)
        kind = _KIND[raw]
        word = kind == 0
        edges = np.diff(word.view(np.int8), prepend=np.int8(0))  # small types, as there is one for each byte
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        breaks = np.cumsum(kind == 2, dtype=np.int32 if len(raw) < 1 << 31 else np.int64)
        #: Whether the next word follows in the same piece.
        self.linked = np.zeros(len(starts), bool)
        self.linked[:-1] = breaks[ends[:-1]] - (kind[ends[:-1]] == 2) == breaks[starts[1:]]
        length = ends - starts
        self.starts = np.concatenate([[0], np.cumsum(length + 1)[:-1]]).astype(np.int64) if len(starts) else starts
        self.data = np.empty(int(length.sum()) + len(starts), np.uint8)
        letters = np.ones(len(self.data), bool)
        letters[self.starts + length] = False
        self.data[letters] = raw[word]
        self.data[~letters] = np.where(self.linked, _SPACE, _END)
        places = np.cumsum([0, *[len(t) + 1 for _, t in group]])
        names = list(dict.fromkeys(lang for lang, _ in group))
        number = {lang: i for i, lang in enumerate(names)}
        of_text = np.array([number[lang] for lang, _ in group], np.int64)
        self.langs = [n.encode() for n in names]
        self.lang = of_text[np.searchsorted(places, starts, "right") - 1]

    def find(self, base: np.ndarray, check: np.ndarray, found: np.ndarray, first: int) -> None:
        """Enter the numbers of a trie's phrases that start at each word, counted from ``first``."""
        roots = np.array([self._root(base, check, lang) for lang in self.langs], np.int32)
        states = roots[self.lang]
        who = np.flatnonzero(states >= 0)
        states, at = states[who], self.starts[who]
        while len(who):
            letters = self.data[at].astype(np.int32)
            from_ = base[states]
            spaces = np.flatnonzero(letters == _SPACE)
            if len(spaces):  # a phrase may end here, and a longer one go on
                last = from_[spaces] + np.int32(_END)
                ended = np.flatnonzero(check[last] == states[spaces])
                found[who[spaces[ended]]] = base[last[ended]] + first
            onward = from_ + letters
            known = check[onward] == states
            ends = letters == _END
            ended = np.flatnonzero(known & ends)
            found[who[ended]] = base[onward[ended]] + first
            known = np.flatnonzero(known & ~ends)
            states, at, who = onward[known], at[known] + 1, who[known]

    @staticmethod
    def _root(base: np.ndarray, check: np.ndarray, lang: bytes) -> int:
        state = 0
        for letter in [*lang, _LANG_END]:
            onward = int(base[state]) + letter
            if check[onward] != state:
                return -1
            state = onward
        return state


class _Tries:
    """The tries of one sent group, with the numbers of their phrases."""

    def __init__(self, table: MappedTable, first: int):
        self.ids, sizes = table.column("id", "i8"), table.column("size", "i8")
        #: Phrases are numbered through all tries of a task, from ``first``.
        self.begin = first + np.concatenate([[0], np.cumsum(sizes)])
        (base, self.ends), (check, _) = table.texts("base"), table.texts("check")
        self.base, self.check = base.view("i4"), check.view("i4")

    def find(self, words: Words, found: np.ndarray) -> None:
        for k, end in enumerate(self.ends):
            part = slice(int(self.ends[k - 1]) // 4 if k else 0, int(end) // 4)
            words.find(self.base[part], self.check[part], found, int(self.begin[k]))

    def names(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of numbered phrases: those of a trie follow each other."""
        k = np.searchsorted(self.begin, numbers, "right") - 1
        return self.ids[k] + numbers - self.begin[k]


def _langs(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    return docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text"))


def _count_words(docs: DataFrame, least: int) -> DataFrame:
    """Words with their counts up to ``least``, and for each language all its words under NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def rows() -> pa.RecordBatch:
            out = [
                (lang, word, total if word is None else min(total, least))
                for lang, words in seen.items() for word, total in words.items()
            ]
            seen.clear()
            langs, words, totals = zip(*out) if out else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(words, pa.binary()), pa.array(totals, pa.int64())],
                ["lang", "word", "n"],
            )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                words = text.translate(_WORDS_ONLY).split()
                counts = seen.setdefault(lang, Counter())
                counts.update(words)
                counts[None] += len(words)
            if sum(map(len, seen.values())) > NOTES // 4:
                yield rows()
        yield rows()

    return _langs(docs).mapInArrow(run, "lang string, word binary, n bigint").groupBy(
        "lang", "word"
    ).agg(F.sum("n").alias("n"))


def _numbered(phrases: DataFrame) -> DataFrame:
    """Stage phrases, sorted by their trie key, with ids that rise in each task's range."""
    key = F.concat(F.encode("lang", "UTF-8"), F.lit(b"\xff"), F.encode("phrase", "UTF-8"), F.lit(b"\n"))
    rows = phrases.withColumn("key", key).repartitionByRange("key").sortWithinPartitions("key")
    return stage(rows.select("*", F.monotonically_increasing_id().alias("id")), "phrases")


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each trie of up to ``BLOCK`` phrases whose ids follow each other."""
    held: list[pa.RecordBatch] = []

    def trie(rows: pa.Table) -> pa.RecordBatch:
        ids, keys = rows.column(0).to_numpy(), rows.column(1).combine_chunks().cast(pa.large_binary())
        offsets = np.frombuffer(keys.buffers()[1], np.int64)[keys.offset:keys.offset + len(keys) + 1]
        data = np.frombuffer(keys.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        base, check = tries.build(data, offsets - offsets[0])
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[0]]), pa.array([len(ids)]), pa.array([base.tobytes()]), pa.array([check.tobytes()])],
            ["id", "size", "base", "check"],
        )

    def cut() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        ids = rows.column(0).to_numpy()
        breaks = [0, *(np.flatnonzero(np.diff(ids) != 1) + 1), len(ids)]
        for lo, hi in zip(breaks, breaks[1:]):
            for at in range(lo, hi, BLOCK):
                yield trie(rows.slice(at, min(BLOCK, hi - at)))

    for batch in batches:
        held.append(batch)
        if sum(len(b) for b in held) >= BLOCK:
            yield from cut()
            held.clear()
    if held and sum(map(len, held)):
        yield from cut()


def _groups(files: list[tuple[str, int]], most: int) -> list[list[str]]:
    """Trie files in groups of at most ``most`` bytes, and of one file at least."""
    groups: list[list[str]] = []
    size = 0
    for name, n in files:
        if not groups or size + n > most:
            groups.append([])
            size = 0
        groups[-1].append(os.path.basename(name))
        size += n
    return groups


def _walk(docs: DataFrame, front: MappedTable, back: MappedTable | None, grow: bool, least: int) -> DataFrame:
    """Counts (a, -1, n) of the phrases of ``front``, and notes (a, b, n) of overlapping ones.

    With ``back``, only notes of a phrase of ``front`` before one of ``back``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = _Tries(front, 0)
        size = int(first.begin[-1])
        other = _Tries(back, size) if back else first
        totals = np.zeros(size, np.int64)
        notes: list[tuple[np.ndarray, np.ndarray]] = []

        def batch_of(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], ["a", "b", "n"])

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([k for k, _ in notes])
            order = np.argsort(keys, kind="stable")  # which joins up runs that are sorted
            keys = keys[order]
            heads = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
            counts = np.concatenate([n for _, n in notes])[order]
            counts = np.add.reduceat(counts, heads, dtype=np.int64) if len(heads) else counts
            keys = keys[heads]
            return keys, np.minimum(counts, least).astype(np.uint8 if least < 256 else np.int64)

        def told(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(keys), 200_000):
                k = keys[at:at + 200_000]
                a, b = (k >> np.uint64(32)).astype(np.int64), (k & np.uint64(0xFFFFFFFF)).astype(np.int64)
                yield batch_of(first.names(a), other.names(b), counts[at:at + 200_000])

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), list(text_bytes(batch.column(1)))
            for group in stretches(langs, texts, STRETCH):
                words = Words(group)
                found = np.full(len(words.starts), -1, np.int64)
                first.find(words, found)
                after = found
                if back:
                    after = np.full(len(words.starts), -1, np.int64)
                    other.find(words, after)
                else:
                    totals += np.bincount(found[found >= 0], minlength=size)
                if grow:
                    both = np.flatnonzero(words.linked[:-1] & (found[:-1] >= 0) & (after[1:] >= 0))
                    pairs = (found[both] << 32 | after[both + 1]).astype(np.uint64)
                    keys, counts = np.unique(pairs, return_counts=True)
                    notes.append((keys, np.minimum(counts, least)))
            if sum(len(k) for k, _ in notes) > NOTES:
                notes[:] = [merged()]
                if len(notes[0][0]) > NOTES // 2:
                    yield from told(*notes.pop())
        if notes:
            yield from told(*merged())
        hit = np.flatnonzero(totals)
        for at in range(0, len(hit), 200_000):
            part = hit[at:at + 200_000]
            yield batch_of(first.names(part), np.full(len(part), -1), totals[part])

    return docs.mapInArrow(run, "a bigint, b bigint, n bigint")


def _level(docs: DataFrame, phrases: DataFrame, grow: bool, least: int, trie_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Counts (a, n) of the phrases, and the pairs (a, b) of them that overlap often enough."""
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "tries")
    # Tasks built by ranges of ids again, so that runs of ids stay together.
    phrases.select("id", "key").repartitionByRange("id").sortWithinPartitions("id").mapInArrow(
        _build, "id bigint, size bigint, base binary, check binary"
    ).write.option("compression", "zstd").mode("errorifexists").parquet(path)
    every = send(spark, path)
    groups = _groups(files_of(spark, path), trie_bytes)
    if len(groups) > 1:
        tables = [MappedTable(g) for g in groups]
    else:
        tables = [every]
    texts = _langs(docs)
    out = None
    for i, front in enumerate(tables):
        for j, back in enumerate(tables):
            if i == j or grow:
                part = _walk(texts, front, None if i == j else back, grow, least)
                out = part if out is None else out.unionByName(part)
    sums = stage(
        out.groupBy("a", "b").agg(F.sum("n").alias("n")).filter((F.col("b") < 0) | (F.col("n") >= least)),
        "phrase-counts",
    )
    return sums.filter("b < 0").select("a", "n"), sums.filter("b >= 0").select("a", "b")


def count_phrases(
    docs: DataFrame, *, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, trie_bytes: int = TRIE_BYTES,
) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases of 1 to ``max_words`` words, one table for each number, and words by language.

    A table holds lang, phrase, id, n, the counts of its beginnings (``heads``) and of its endings
    (``tails``), both from one word on, and the ids of the phrases without their last and first word.

    - A NULL text is empty, a NULL language ``und``; other columns are ignored.
    - Words end at space, tab and the ends of pieces; only A-Z are lowered. Overlaps count.
    - A stretch is cut between pieces only, so memory follows the longest piece beyond ``STRETCH``.
    """
    counted = stage(_count_words(docs, min_count), "words")
    totals = counted.filter("word IS NULL").select("lang", "n")
    none = F.array().cast("array<bigint>")
    phrases = counted.filter((F.col("n") >= min_count) & F.col("word").isNotNull()).select(
        "lang", F.decode("word", "UTF-8").alias("phrase"), none.alias("heads"), none.alias("tails"),
        F.lit(None).cast("bigint").alias("a"), F.lit(None).cast("bigint").alias("b"),
    )
    levels: list[DataFrame] = []
    for size in range(1, max_words + 1):
        phrases = _numbered(phrases)
        counts, pairs = _level(docs, phrases, size < max_words, min_count, trie_bytes)
        known = stage(
            phrases.drop("key").join(counts.withColumnRenamed("a", "id"), "id"), f"phrases-{size}"
        )
        levels.append(known)
        front, back = known.select(F.struct("*").alias("f")), known.select(F.struct("*").alias("g"))
        phrases = pairs.join(front, F.col("f.id") == F.col("a")).join(back, F.col("g.id") == F.col("b")).select(
            F.col("f.lang").alias("lang"),
            F.concat("f.phrase", F.lit(" "), F.substring_index("g.phrase", " ", -1)).alias("phrase"),
            F.concat("f.heads", F.array("f.n")).alias("heads"),
            F.concat("g.tails", F.array("g.n")).alias("tails"),
            "a", "b",
        )
    return levels, totals


def collocations(
    docs: DataFrame, *, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP,
    covered: int = COVERED, trie_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``max_words`` words: lang, rank, phrase, a, l, r, n, score.

    A phrase seen ``a`` times is cut after each of its words but the last; with ``l`` and ``r`` the
    counts of both parts its score is floor(1000000 a a / (l r)) of the worst cut, the first of equal
    ones. It is dropped if a longer phrase of at least ``min_count`` holds ``covered`` percent
    of its occurrences. ``n`` counts all words of the language. See :func:`count_phrases` for
    odd rows; a language without frequent phrases, and an empty table, give no rows.
    """
    levels, totals = count_phrases(docs, max_words=max_words, min_count=min_count, trie_bytes=trie_bytes)
    exact = "CAST({} AS DECIMAL(38, 0))"
    out = None
    for shorter, longer in zip(levels[1:], [*levels[2:], None]):
        cuts = F.transform(
            F.sequence(F.lit(1), F.size("heads")),
            lambda k: F.struct(
                k.alias("k"), F.element_at("heads", k).alias("l"),
                F.element_at("tails", F.size("tails") + 1 - k).alias("r"),
            ),
        )
        rows = shorter.withColumn("cuts", cuts)
        score = f"{exact.format('1000000')} * {exact.format('n')} * {exact.format('n')} div ({exact.format('c.l')} * {exact.format('c.r')})"
        rows = rows.withColumn(
            "cut", F.array_min(F.expr(f"transform(cuts, c -> struct({score} AS score, c.k AS k, c.l AS l, c.r AS r))"))
        )
        if longer is not None:
            holds = longer.select(F.explode(F.array("a", "b")).alias("id"), "n").groupBy("id").agg(
                F.max("n").alias("most")
            )
            rows = rows.join(holds, "id", "left").filter(
                F.coalesce(100 * F.col("most") < covered * F.col("n"), F.lit(True))
            )
        rows = rows.select(
            "lang", "phrase", F.col("n").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
            F.col("cut.score").cast("long").alias("score"),
        )
        out = rows if out is None else out.unionByName(rows)
    # A language may be most of the table: the first of each share are ranked, then those of all.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    share = Window.partitionBy("lang", F.pmod(F.hash("phrase"), F.lit(64)))
    first = out.withColumn("rank", F.row_number().over(share.orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ).filter(F.col("rank") <= top)
    return join_same(ranked, totals, ["lang"]).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
