from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from stockroom.llm.queries import URL_RULES
from stockroom.llm.url_filters import filter_urls, lexical_features, url_host, url_path

URLS = [
    "https://A.Example.ORG/es/1?x=1&y=2",
    "http://example.org/en/17#top",
    "http://notexample.org/en/1",
    "http://b.example.com/fr/a/b-c.html",
    "http://example.com/de/9",
    "http://example.net/en/5",
    "http://org",
    "ftp://org?q=/",
    "no scheme",
    "",
    None,
    "http://x.org/" + "9" * 5000,
    "http://a.net/http://b.org/x",
]


def expected_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def expected_rule(host, path):
    fits = [
        rule
        for rule in URL_RULES
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)
    ]
    return max(fits, key=lambda rule: len(rule.name), default=None)


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def test_parts_rules_and_verdicts(spark):
    more = [f"http://h{i}.example.{end}/{lang}/{i}" for i in range(30) for end in ("org", "com") for lang in ("es", "de")]
    rows = pages(spark, URLS + more + URLS[:2])
    found = filter_urls(rows, URL_RULES).collect()
    assert len(found) == len(URLS) + len(more) + 2
    for row in found:
        host, path = expected_parts(row["url"])
        rule = expected_rule(host, path)
        assert (row["host"], row["path"]) == (host, path)
        assert row["rule"] == (rule.name if rule else None)
        assert row["verdict"] == rule.verdict if rule else row["verdict"] in ("allow", "block")
        assert 0 <= row["block_score"] <= 1
    by_url = {}
    for row in found:
        assert by_url.setdefault(row["url"], row["verdict"]) == row["verdict"]


def test_trees_learn_what_rules_say(spark):
    blocked = [f"http://s{i}.example.com/de/{'7' * 20}{i}?a=1&b=2&c=3" for i in range(200)]
    allowed = [f"http://s{i}.example.org/x{i % 9}" for i in range(200)]
    open_ = ["http://q.example.net/en/" + "7" * 22 + "?a=1&b=2&c=3", "http://q.example.net/x3"]
    found = filter_urls(pages(spark, blocked + allowed + open_), URL_RULES).where("rule is null").orderBy("page_id")
    assert [row["verdict"] for row in found.collect()] == ["block", "allow"]


def test_features(spark):
    url = F.col("url")
    rows = pages(spark, ["http://a-b.example.com/x/y9.html?p=1&q=2", ""])
    parts = {"host": url_host(url), "path": url_path(url)}
    rows = rows.withColumns(parts).withColumns(lexical_features(url, F.col("host"), F.col("path"))).orderBy("page_id")
    one, empty = rows.collect()
    text = one["url"]
    shares = [n / len(text) for n in Counter(text).values()]
    assert math.isclose(one["f_entropy"], -sum(p * math.log2(p) for p in shares), rel_tol=1e-9)
    assert (one["f_length"], one["f_depth"], one["f_parameters"], one["f_hyphens"]) == (len(text), 2, 2, 1)
    assert one["f_digit_ratio"] == 3 / len(text)
    assert (empty["f_length"], empty["f_entropy"], empty["f_parameters"]) == (0, 0.0, 0)


def test_one_kind_of_label_empty_tables_and_clashing_columns(spark):
    only = pages(spark, ["http://a.org/x", "http://a.net/y", None])
    assert {row["verdict"] for row in filter_urls(only, URL_RULES).collect()} == {"allow"}
    assert filter_urls(only.limit(0), URL_RULES).count() == 0
    clash = only.withColumns({"verdict": F.lit("old"), "host": F.lit(1), "note": F.lit("kept")})
    found = filter_urls(clash, URL_RULES)
    assert found.columns == ["page_id", "url", "verdict", "host", "note", "path", "rule", "block_score"]
    assert {row["verdict"] for row in found.collect()} == {"allow"}


def test_no_python_runs(spark):
    plan = filter_urls(pages(spark, URLS), URL_RULES)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)
