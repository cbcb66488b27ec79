"""Exact copies and URL rules against brute force."""

from __future__ import annotations

import hashlib
import random
import re

from texts import documents  # noqa: F401

from tallyhouse.llm import exact_dedup, url_filter

WHITE = re.compile(r"[\x20\x09-\x0D]+")


def expected_groups(rows):
    norm = {i: WHITE.sub("", text or "") for i, text in rows}
    size = {i: len(text or "") for i, text in rows}
    result = {}
    for i in norm:
        group = [j for j in norm if norm[j] == norm[i]]
        keep = min(group, key=lambda j: (-size[j], j))
        result[i] = (keep, len(group), keep == i, hashlib.sha256(norm[i].encode()).hexdigest())
    return result


def copies():
    draw = random.Random(1)
    base = ["".join(draw.choice("abcdef. \n") for _ in range(draw.randrange(0, 9000))) for _ in range(12)]
    rows = [(i, draw.choice(base)) for i in range(60)]
    rows += [(60 + i, text.replace(" ", "\t \x0b")) for i, (_, text) in enumerate(rows[:20])]
    rows += [(100, None), (101, ""), (102, " \n\r\x0c"), (103, " "), (104, "x" * 50_000), (105, "x" * 49_999 + "y")]
    return rows


def found(df):
    return {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect()}


def test_groups_of_copies(documents):
    rows = copies()
    assert found(exact_dedup.exact_duplicates(documents(*rows))) == expected_groups(rows)


def test_contents_that_share_a_digest_are_told_apart(documents):
    rows = copies()
    for bits in (1, 3):
        got = exact_dedup.exact_duplicates(documents(*rows), digest_bits=bits, least=16, most=64)
        assert found(got) == expected_groups(rows)


def test_empty_table_and_repeated_rows(documents, spark):
    none = documents((1, "a")).filter("doc_id > 5")
    assert exact_dedup.exact_duplicates(none).count() == 0
    twice = exact_dedup.exact_duplicates(documents((1, "a"), (1, "a"), (None, "a"))).collect()
    assert sorted((r["doc_id"] or 0, r["keep_id"], r["group_size"], r["kept"]) for r in twice) == [
        (0, 1, 3, False), (1, 1, 3, True), (1, 1, 3, True),
    ]


URLS = [
    (1, "http://a.example.org/es/x"), (2, "https://EXAMPLE.org/en/1?q"), (3, "http://b.org/fr/"), (4, "http://x.com/fr/1"),
    (5, "http://x.com/de/#a"), (6, "http://x.com"), (7, None), (8, "no url"), (9, "ftp://org/"), (10, "http://notexample.org/es/"),
    (11, "http://example.org/en/12"), (12, "http://a.b.c.d.e.org/" + "p/" * 5000), (13, ""), (14, "http:///es/"),
    (15, "http://x.net/a\nb?c"), (16, "://com/de/"), (16, "://com/de/"), (17, "http://ORG?x"), (18, "http://É.ORG/es/"),
]


def expected_verdicts(rules):
    result = []
    for i, url in URLS:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest).group()
            path = re.match(r"[^?#]*", rest[len(host):]).group()
            host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
        fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
        result.append((i, host, path, best and best[0] + best[1], best[2] if best else "allow"))
    return sorted(result)


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in URLS], "page_id long, url string, html string, row string")
    for most in (100, 2):  # broadcast rules, and rules met over salts
        got = url_filter.judge_urls(pages, url_filter.given_rules(spark), most_broadcast=most)
        assert sorted(map(tuple, got.collect())) == expected_verdicts(url_filter.RULES)
    none = url_filter.judge_urls(pages.filter("page_id < 0"), url_filter.given_rules(spark))
    assert none.count() == 0
    no_rules = url_filter.judge_urls(pages, url_filter.given_rules(spark).filter("false"))
    assert {r["verdict"] for r in no_rules.collect()} == {"allow"}


def test_precedence_of_equal_rules(spark):
    rules = spark.createDataFrame([("a.b", "/", "allow"), ("b", "/xy", "block"), ("a.b", "/", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.b/xyz")], "page_id long, url string")
    assert url_filter.judge_urls(pages, rules).head()["rule"] == "a.b/"
    assert url_filter.judge_urls(pages.selectExpr("page_id", "'http://a.b/q' AS url"), rules).head()["verdict"] == "block"


def test_no_python_in_native_plans(documents, spark):
    plan = exact_dedup.exact_duplicates(documents((1, "a")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
