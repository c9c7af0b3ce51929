"""URL filtering against block and allow rules, by a sorted digest array.

A rule is a host with the beginning of a path, as in ``example.net/en/``. It fits its host and all
subdomains, where the path of the url starts with the rule's path; the longest rule that fits wins.

The rules are kept as one array of 64-bit xxhash digests in rising order, with the rules themselves
beside it. Executors map the array. A url asks for every ending of its host with every beginning of
its path that is as long as some rule's path; the digests of a batch are found by one vectorised binary
search, and the stored rule is compared in full, so equal digests of other rules do no harm.

An index of more than ``MAX_INDEX_BYTES`` is not sent to executors; urls are then joined with it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlake.llm.common import ascii_lower
from stintlake.llm.mapped import MappedTable, files_of, send
from stintlake.session import fresh_path

#: Seed of Spark's xxhash64, which digests the rules.
SEED = 42
#: The largest index, in bytes of its files, that every executor keeps on its disk.
MAX_INDEX_BYTES = 2 << 30
ALLOW, BLOCK = "allow", "block"
_ADDED = ("host", "path", "rule", "verdict")
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?`` or ``#``, with A-Z in lower case."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


class RuleIndex:
    """Rules at rest: a table of ``digest``, ``rule`` and ``blocked``, sorted by digest."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.bytes = sum(n for _, n in files_of(spark, path))
        rest = F.length("rule") - F.length(F.substring_index("rule", "/", 1))
        #: Lengths of the rules' paths; as many as differ, and no longer than a url.
        self.lengths = sorted(r[0] for r in self.table().select(rest).distinct().collect())

    def table(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


def build_index(rules: DataFrame, path: str | None = None) -> RuleIndex:
    """Write the index of ``rules(rule, verdict)``.

    - A-Z in hosts count as a-z. NULL rules and rules without a host are left out; a rule
      without ``/`` fits every path. Any verdict but ``allow`` blocks.
    - A rule given twice counts once; if its verdicts differ, it blocks.
    """
    host = F.substring_index("rule", "/", 1)
    rest = F.substring(F.col("rule"), F.length(host) + 1, F.length("rule"))
    rows = rules.filter(host != "").groupBy(F.concat(ascii_lower(host), rest).alias("rule")).agg(
        F.max(~F.col("verdict").eqNullSafe(ALLOW)).alias("blocked")
    )
    path = path or fresh_path(rules.sparkSession, "url-rules")
    rows.select(F.xxhash64("rule").alias("digest"), "rule", "blocked").repartitionByRange(
        "digest"
    ).sortWithinPartitions("digest", "rule").write.mode("errorifexists").parquet(path)
    return RuleIndex(rules.sparkSession, path)


class _Prober:
    """Probes a batch of hosts and paths in the mapped arrays."""

    def __init__(self, table: MappedTable, lengths: list[int]):
        self.keys = table.column("digest", "i8")
        self.text, self.ends = table.texts("rule")
        self.blocked = table.column("blocked", "?")
        self.lengths = lengths

    def _rule(self, at: int) -> bytes:
        return self.text[self.ends[at - 1] if at else 0:self.ends[at]].tobytes()

    def _candidates(self, hosts: Iterable[str], paths: Iterable[str]) -> Iterator[tuple[int, str]]:
        """Number of the url and a possible rule, the longest first, of equal ones that of the longer host."""
        for i, (host, path) in enumerate(zip(hosts, paths)):
            if not host:
                continue
            labels, fits = host.split("."), [n for n in self.lengths if n <= len(path)]
            ends = [".".join(labels[k:]) for k in range(len(labels))]
            found = [(len(e) + n, len(e), e + path[:n]) for e in ends for n in fits if e]
            for _, _, rule in sorted(found, reverse=True):
                yield i, rule

    def probe(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str]]:
        rules: list[str | None] = [None] * len(hosts)
        verdicts = [ALLOW] * len(hosts)
        owners, asked = [], []
        for i, rule in self._candidates(hosts, paths):
            owners.append(i)
            asked.append(rule.encode())
        digests = np.array(
            [xxhash.xxh64_intdigest(rule, SEED) for rule in asked], np.uint64
        ).view(np.int64)
        at = np.searchsorted(self.keys, digests)
        for k in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == digests) if len(self.keys) else ():
            i, place = owners[k], int(at[k])
            if rules[i] is not None:  # a longer rule fits
                continue
            while place < len(self.keys) and self.keys[place] == digests[k]:
                if self._rule(place) == asked[k]:
                    rules[i] = asked[k].decode()
                    verdicts[i] = BLOCK if self.blocked[place] else ALLOW
                    break
                place += 1
        return rules, verdicts


def judge_urls(pages: DataFrame, index: RuleIndex, *, url: str = "url",
               max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """All rows of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    - ``rule`` is the longest that fits, or NULL; without one the verdict is ``allow``.
    - A NULL url, or one without ``://``, has an empty host and path, and no rule.
    - Input columns named as the four are replaced; an empty table gives no rows.
    """
    names = [c for c in pages.columns if c not in _ADDED]
    rows = pages.select(*names, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    if index.bytes > max_index_bytes:
        return _joined(rows, index)
    schema = T.StructType([*rows.schema.fields])
    schema = schema.add("rule", T.StringType()).add("verdict", T.StringType())
    table, lengths = send(index.spark, index.path), index.lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prober = None
        for batch in batches:
            prober = prober or _Prober(table, lengths)
            hosts, paths = (batch.column(len(names) + k).to_pylist() for k in (0, 1))
            rules, verdicts = prober.probe(hosts, paths)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                [*batch.schema.names, "rule", "verdict"],
            )

    return rows.mapInArrow(run, schema)


def _joined(rows: DataFrame, index: RuleIndex) -> DataFrame:
    """The same by a join of possible rules with the index."""
    labels = F.split("host", r"\.")
    sizes = F.array(*[F.lit(n) for n in index.lengths]).cast("array<int>")
    possible = rows.select("host", "path").filter("host <> ''").distinct().select(
        "host", "path",
        F.explode(F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
        )).alias("end"),
    ).filter("end <> ''").withColumn(
        "size", F.explode(F.filter(sizes, lambda n: n <= F.length("path")))
    ).select("host", "path", "end", F.concat("end", F.expr("left(path, size)")).alias("rule"))
    found = possible.withColumn("digest", F.xxhash64("rule")).join(index.table(), ["digest", "rule"])
    best = found.groupBy(F.col("host").alias("_h"), F.col("path").alias("_p")).agg(
        F.max(F.struct(F.length("rule"), F.length("end"), "rule", "blocked")).alias("_best")
    )
    kept = rows.select(F.struct("*").alias("_row"))
    both = kept.join(
        best, (F.col("_row.host") == F.col("_h")) & (F.col("_row.path") == F.col("_p")), "left"
    )
    return both.select(
        "_row.*", F.col("_best.rule").alias("rule"),
        F.when(F.col("_best.blocked"), BLOCK).otherwise(ALLOW).alias("verdict"),
    )


def keep_allowed(pages: DataFrame, index: RuleIndex, *, url: str = "url",
                 max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """The rows of ``pages`` whose url is not blocked, with the same columns."""
    packed = pages.select(F.struct("*").alias("row"), F.col(url).alias("url"))
    return judge_urls(packed, index, max_index_bytes=max_index_bytes).filter(
        F.col("verdict") == ALLOW
    ).select("row.*")
