import random

import pytest
from pyspark.sql import functions as F

from stintlake.llm import url_filters as U
from stintlake.llm.queries import ORACLE, QUERIES, URL_RULES
from tests.compare import connect, differences


def brute(url, rules):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    best = None
    for rule, verdict in rules:
        own, slash, tail = rule.partition("/")
        if host and (host == own or host.endswith("." + own)) and path.startswith(slash + tail):
            best = max(best or (0, 0, "", ""), (len(rule), len(own), rule, verdict))
    return (host, path, best[2], best[3]) if best else (host, path, None, "allow")


@pytest.mark.parametrize("most", [U.MAX_INDEX_BYTES, 0])
def test_every_rule_tried(spark, most):
    """Probed in the arrays, and joined where the index is too large for them."""
    dice = random.Random(1)
    names, tails = ["a", "b", "net", "com", "ü", "x-y"], ["", "/", "/a", "/a/", "/a/b", "/A/", "/ü/x"]
    host = lambda: ".".join(dice.choice(names) for _ in range(dice.randint(1, 4)))
    rules = list({host() + dice.choice(tails): dice.choice(["allow", "block"]) for _ in range(80)}.items())
    urls = [f"{dice.choice(['http', 'https'])}://{host()}{dice.choice(tails)}{dice.choice(['', 'c', '?q=/a', '#x://b'])}"
            for _ in range(400)]
    urls += [None, "", "no host", "://", "http://", "http:///a/", "HTTP://A.NET/a", "http://a.net:80/", "http://a..net/a/",
             "http://.net/", "http://net./", "x\ny://a.com/a\nb?c", "http://a.net?x://b.com/", "http://a.net/" + "z" * 100_000]
    index = U.build_index(spark.createDataFrame(rules, "rule string, verdict string"))
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").repartition(3)
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(pages, index, max_index_bytes=most).collect()}
    assert out == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_equal_digests_are_told_apart(spark):
    index = U.build_index(spark.createDataFrame([("b.net/", "block"), ("a.net/", "allow")], "rule string, verdict string"))
    same = spark.read.parquet(index.path).collect()
    path = index.path + "-same"
    digest = next(r.digest for r in same if r.rule == "b.net/")
    index.table().withColumn("digest", F.lit(digest)).coalesce(1).sortWithinPartitions("rule").write.parquet(path)
    pages = spark.createDataFrame([(0, "http://x.b.net/")], "page_id bigint, url string")
    row = U.judge_urls(pages, U.RuleIndex(spark, path)).first()
    assert (row.rule, row.verdict) == ("b.net/", "block")


def test_odd_rules_and_tables(spark):
    rules = [(None, "block"), ("", "block"), ("/x", "block"), ("TWICE.net", "allow"), ("twice.net", "block"), ("odd.net/", None)]
    index = U.build_index(spark.createDataFrame(rules, "rule string, verdict string"))
    pages = spark.createDataFrame(
        [(0, "http://twice.net"), (1, "http://odd.net/"), (2, None), (3, "http://free.net/x"), (3, "http://free.net/x")],
        "page_id bigint, url string",
    ).selectExpr("*", "'h' AS host", "1 AS rule", "2 AS verdict", "3 AS row", "4 AS digest", "5 AS _h")
    out = {r.page_id: (r.rule, r.verdict) for r in U.judge_urls(pages, index).collect()}
    assert out == {0: ("twice.net", "block"), 1: ("odd.net/", "block"), 2: (None, "allow"), 3: (None, "allow")}
    kept = U.keep_allowed(pages, index)
    assert kept.columns == pages.columns and sorted(r.page_id for r in kept.collect()) == [2, 3, 3]
    assert U.judge_urls(pages.limit(0), index).count() == 0
    none = U.build_index(spark.createDataFrame([], "rule string, verdict string"))
    assert U.keep_allowed(pages, none).count() == 5
    assert U.judge_urls(pages, none, max_index_bytes=-1).filter("rule IS NULL").count() == 5


def test_query_beside_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    count, bad = differences(QUERIES["op12_url_filters"](spark, sf), connect(sf), ORACLE["op12_url_filters"])
    assert count == 250 and not bad and len(URL_RULES) == 4
