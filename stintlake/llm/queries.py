"""The registered queries of this folder and the SQL that checks them, where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.llm import (
    collocations,
    conversations,
    decontamination,
    exact_dedup,
    jaccard_join,
    language,
    licenses,
    lm_scoring,
    packing,
    quality,
    sharding,
    token_files,
    url_filters,
)
from stintlake.llm.common import crc_remainder, documents, ship, stage, table
from stintlake.operators.grouping import join_same
from stintlake.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: A-Z to a-z, and the UTF-8 bytes of a text, in the other engine.
_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        return fn

    return register


@query("op4_sharding")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_exact_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact_dedup.DigestIndex(spark, f"digests_{uuid.uuid4().hex}")
    found = index.deduplicate(documents(spark, sf_dir))
    index.drop()
    return found.select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


ORACLE["op5_exact_dedup"] = f"""
    SELECT doc_id, MAX(doc_id) OVER g AS keep_id, COUNT(*) OVER g AS group_size,
      doc_id = MAX(doc_id) OVER g AS kept, sha256({_LOWER}) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY {_LOWER})"""


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), keep_ids=False)


@query("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.fit(
        docs.filter(crc_remainder(F.col("doc_id"), 3) != 1), table(spark, sf_dir, "labels")
    )
    return quality.score(docs, model).select(
        "doc_id", (crc_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op3_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = decontamination.find_matches(docs, table(spark, sf_dir, "benchmark"))
    hit = F.expr("aggregate(hit_spans, 0L, (n, s) -> n + s.last - s.first + 1)")
    return found.select(
        "doc_id", F.col("hit_words").cast("long").alias("n_words"), hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ","), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


@query("op2_language")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_remainder(F.col("doc_id"), 4) == 2
    learned = language.fit(docs.filter(~held_out).select("doc_id", "text", "lang"))
    return language.identify(docs.select("doc_id", "text"), learned).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "entropy", "accepted"
    )


@query("op7_jaccard_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir)).select(
        "doc_id", "n_shingles", "component_id"
    )


@query("op9_lm_scoring")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = crc_remainder(F.col("doc_id"), 10) == 0
    model = lm_scoring.train(docs.filter(~held_out))
    scored = lm_scoring.score(docs, model)
    return scored.withColumn("held_out", crc_remainder(F.col("doc_id"), 10) == 0)


@query("op6_licenses")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", F.array_join("licenses", ",").alias("licenses"),
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join("unmatched", ",").alias("unmatched"),
        F.col("copyrights").cast("long").alias("copyrights"),
        F.col("unknown").cast("long").alias("unknown"),
    )


@query("op1_token_files")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), path)
    return token_files.read_token_files(spark, path, ids=False)


@query("op11_conversations")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    harmed = conversations.damage(rows)
    solved = stage(conversations.solve(harmed), "conversations-solved")
    digests = conversations.repaired_digests(harmed, solved)
    every = rows.select("conv_id").distinct()
    found = join_same(join_same(every, solved, ["conv_id"], "left"), digests, ["conv_id"], "left")
    faults = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in faults],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


#: crc32 of "conv_id:turn", bit by bit.
_CRC = """xor(4294967295::BIGINT, list_reduce(
      list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
        lambda x: unicode(x)::BIGINT),
      lambda c, b: list_reduce(range(8), lambda d, i: xor(d >> 1, (d & 1) * 3988292384), xor(c, b)),
      4294967295::BIGINT))"""

# The best prefix of each state, row by row, with the text that it gives.
ORACLE["op11_conversations"] = f"""
    WITH RECURSIVE harmed AS (
      SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS kind
            FROM conversations), (VALUES (1), (2)) AS copies(copy)
      WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
    digests AS (
      SELECT *, sha256(length(role) || ':' || role || text) AS digest, left(role, 1) AS initial,
        rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM harmed),
    ordered AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS n
      FROM digests),
    marked AS (
      SELECT *, bare = '' AS blank, bare <> '' AND n > min(n) OVER (PARTITION BY conv_id, digest) AS repeated,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY n) AS earlier,
        (right(bare, 1) NOT IN ('.', '!', '?'))::BIGINT AS cut FROM ordered),
    counted AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (blank) AS blank, count(*) FILTER (repeated) AS duplicate,
        count(*) FILTER (NOT blank AND NOT repeated AND cut = 1) AS truncated,
        count(*) FILTER (earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS last
      FROM marked GROUP BY conv_id),
    inserts(a, b, cost, letters, lines) AS (
      SELECT * FROM (VALUES (0, 2, 2, 'I', chr(10) || 'user:'), (1, 2, 2, 'I', chr(10) || 'user:'),
        (3, 2, 2, 'I', chr(10) || 'user:'), (2, 3, 2, 'I', chr(10) || 'assistant:'),
        (0, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
        (1, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
        (3, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
        (2, 2, 4, 'II', chr(10) || 'assistant:' || chr(10) || 'user:'),
        (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''))),
    moves(b, initial, c, cost, letter, role) AS (
      SELECT * FROM (VALUES (0, 's', 1, 0, 'K', NULL), (0, 'u', 2, 0, 'K', NULL), (1, 'u', 2, 0, 'K', NULL),
        (3, 'u', 2, 0, 'K', NULL), (2, 'a', 3, 0, 'K', NULL), (0, NULL, 2, 2, 'R', 'user'),
        (1, NULL, 2, 2, 'R', 'user'), (3, NULL, 2, 2, 'R', 'user'), (2, NULL, 3, 2, 'R', 'assistant'),
        (0, NULL, 0, 3, 'D', NULL), (1, NULL, 1, 3, 'D', NULL), (2, NULL, 2, 3, 'D', NULL),
        (3, NULL, 3, 3, 'D', NULL))),
    best(conv_id, n, state, p) AS (
      SELECT conv_id, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': '', 'lines': ''}} FROM counted
      UNION ALL
      SELECT best.conv_id, best.n + 1, moves.c, min({{
        'cost': (best.p).cost + inserts.cost + moves.cost + CASE WHEN letter = 'D' THEN 0 ELSE cut END,
        'audit': (best.p).audit || letters || letter,
        'lines': (best.p).lines || inserts.lines || CASE WHEN letter = 'D' THEN ''
          ELSE chr(10) || coalesce(moves.role, marked.role) || ':' || text END}})
      FROM best JOIN marked ON marked.conv_id IS NOT DISTINCT FROM best.conv_id AND marked.n = best.n + 1
      JOIN inserts ON inserts.a = best.state JOIN moves ON moves.b = inserts.b
      WHERE letter = 'D' OR NOT (blank OR repeated) AND coalesce(moves.initial, marked.initial) = marked.initial
      GROUP BY best.conv_id, best.n + 1, moves.c),
    done AS (
      SELECT counted.conv_id, min({{'cost': (p).cost + inserts.cost, 'audit': (p).audit || letters,
        'lines': (p).lines || inserts.lines}}) AS p
      FROM best JOIN counted ON counted.conv_id IS NOT DISTINCT FROM best.conv_id AND n = last
      JOIN inserts ON inserts.a = state WHERE b IN (0, 3) GROUP BY counted.conv_id)
    SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
      coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
      coalesce(illegal, 0) AS illegal, coalesce((p).cost, 0) AS cost, coalesce((p).audit, '') AS audit,
      sha256(coalesce(substr((p).lines, 2), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) AS every
    LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM every.conv_id
    LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM every.conv_id"""


#: Fixed values of the task.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@query("op12_url_filters")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = url_filters.build_index(spark.createDataFrame(URL_RULES, "rule string, verdict string"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge_urls(pages, index).select("page_id", "host", "path", "rule", "verdict")


ORACLE["op12_url_filters"] = f"""
    WITH rules(rule, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
    parts AS (
      SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, row_number() OVER () AS n
      FROM pages),
    fitting AS (
      SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
      FROM parts JOIN rules ON ('.' || host) LIKE ('%.' || split_part(rule, '/', 1))
        AND starts_with(path, substr(rule, strpos(rule, '/'))) GROUP BY n)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
    FROM parts LEFT JOIN fitting USING (n)"""


@query("op13_collocations")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


#: All occurrences of phrases of one to three words within pieces, by language.
ORACLE["op13_collocations"] = f"""
    WITH pieces AS (
      SELECT lang, piece, row_number() OVER () AS id FROM (
        SELECT coalesce(lang, 'und') AS lang,
          unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
    words AS (
      SELECT lang, id, unnest(w) AS a, unnest(range(len(w))) AS i FROM (
        SELECT lang, id, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w
        FROM pieces)),
    followed AS (
      SELECT lang, a, lead(a) OVER p AS b, lead(a, 2) OVER p AS c FROM words
      WINDOW p AS (PARTITION BY id ORDER BY i)),
    f1 AS (SELECT lang, a, count(*) AS n FROM followed GROUP BY ALL HAVING count(*) >= 10),
    f2 AS (SELECT lang, a, b, count(*) AS n FROM followed WHERE b IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
    f3 AS (SELECT lang, a, b, c, count(*) AS n FROM followed WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
    longer AS (
      SELECT lang, a, b, max(n) AS most FROM (
        SELECT lang, a, b, n FROM f3 UNION ALL SELECT lang, b, c, n FROM f3) GROUP BY ALL),
    cuts AS (
      SELECT f2.lang, f2.a || ' ' || f2.b AS phrase, f2.n AS a, 1 AS cut, l.n AS l, r.n AS r
      FROM f2 JOIN f1 AS l ON l.lang = f2.lang AND l.a = f2.a JOIN f1 AS r ON r.lang = f2.lang AND r.a = f2.b
      LEFT JOIN longer ON longer.lang = f2.lang AND longer.a = f2.a AND longer.b = f2.b
      WHERE most IS NULL OR 100 * most < 50 * f2.n
      UNION ALL SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || c, f3.n, 1, l.n, r.n
      FROM f3 JOIN f1 AS l ON l.lang = f3.lang AND l.a = f3.a
      JOIN f2 AS r ON r.lang = f3.lang AND r.a = f3.b AND r.b = f3.c
      UNION ALL SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || c, f3.n, 2, l.n, r.n
      FROM f3 JOIN f2 AS l ON l.lang = f3.lang AND l.a = f3.a AND l.b = f3.b
      JOIN f1 AS r ON r.lang = f3.lang AND r.a = f3.c),
    worst AS (
      SELECT lang, phrase, a, min({{'score': (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT,
        'cut': cut, 'l': l, 'r': r}}) AS m FROM cuts GROUP BY lang, phrase, a),
    ranked AS (
      SELECT lang, phrase, a, m.l AS l, m.r AS r, m.score AS score,
        row_number() OVER (PARTITION BY lang ORDER BY m.score DESC, a DESC, encode(phrase)) AS rank FROM worst)
    SELECT ranked.lang, rank, phrase, ranked.a, l, r, n, score FROM ranked
    JOIN (SELECT lang, count(*) AS n FROM words GROUP BY lang) AS total ON total.lang = ranked.lang
    WHERE rank <= 2000"""
