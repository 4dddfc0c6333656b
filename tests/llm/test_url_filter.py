from __future__ import annotations

import re

import pytest

from loglathe.llm import url_filter


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fitting = [name + prefix for _, name, prefix in url_filter.RULES
               if (host == name or host.endswith("." + name)) and path.startswith(prefix)]
    return host, path, max(fitting, key=len, default=None)


URLS = [
    None, "", "no scheme/x", "http://", "https://A.Example.NET/en/x?y#z", "http://net/", "http://net", "http://a.net?q=/en/",
    "ftp://b.example.com/de/", "http://example.com/DE/", "http://myexample.net/en/1", "http://x.org/fr/://y",
    "http://É.org/fr", "a://b://c/d", "http://www.freecasinogames.com/en/1.html", "http://h.example.com/de/x#/en/",
    "http://adultbets.example.com/fr/", "http://" + "ab" * 400 + ".com/" + "c" * 3000,
]
HOSTS = ["riverbank", "stonebridge", "gardenhouse", "oldmill"]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, u, "<p>river bank stone bridge games free</p>") for i, u in enumerate(URLS)]
    rows += [(100 + i, f"http://www.{HOSTS[i % 4]}.example.com/en/{i}.html", "garden house old mill <b>") for i in range(60)]
    rows += [(200 + i, f"http://casinogames{'x' * (i % 3)}.example.com/en/win/{i}", None) for i in range(20)]
    rows += [rows[5], (None, "http://pokergames.com/en/1", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return rows, url_filter.judge(pages).collect()


def test_hosts_paths_and_rules(judged):
    rows, out = judged
    assert len(out) == len(rows)
    expected = sorted(((r[0], *plain(r[1])) for r in rows), key=repr)
    assert sorted(((r["page_id"], r["host"], r["path"], r["rule"]) for r in out), key=repr) == expected


def test_verdicts(judged):
    _, out = judged
    action = {name + prefix: what for what, name, prefix in url_filter.RULES}
    for r in out:
        if r["rule"]:
            assert r["verdict"] == action[r["rule"]]
        elif 100 <= (r["page_id"] or 0) < 200 or not r["host"]:
            assert r["verdict"] == "allow"
        elif r["page_id"] and r["page_id"] >= 200:
            assert r["verdict"] == "block"


def test_segmentation(spark):
    words = spark.createDataFrame([("free", 50), ("casino", 40), ("games", 30), ("ga", 60), ("mes", 60)],
                                  "word string, n bigint")
    runs = spark.createDataFrame([("freecasinogames",), ("qqcasino",), ("q" * 300,)], "run string")
    cuts = {r["run"]: r["words"] for r in url_filter.segmented(runs, words).collect()}
    assert cuts["freecasinogames"] == ["free", "casino", "games"]
    assert cuts["qqcasino"] == ["qq", "casino"]
    assert cuts["q" * 300] == ["q" * 300]


def test_empty_table_and_no_seeds(spark):
    schema = "page_id bigint, url string, html string"
    assert url_filter.judge(spark.createDataFrame([], schema)).count() == 0
    (row,) = url_filter.judge(spark.createDataFrame([(1, "http://quiet.com/en/", "x")], schema)).collect()
    assert row["verdict"] == "allow"


def test_urls_without_words_are_allowed(spark):
    rows = [(i, f"http://casino{i}.com", "casino play") for i in range(10)]
    rows += [(100, None, "a"), (101, "no scheme", "b"), (102, "http://", "c"), (103, "http://1.2.3.4/5", None)]
    out = {r["page_id"]: r for r in url_filter.judge(
        spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert [(out[i]["verdict"], out[i]["score"]) for i in (100, 101, 102, 103)] == [("allow", None)] * 4
    assert all(out[i]["verdict"] == "block" for i in range(10))


def test_further_columns_do_not_matter(spark):
    from pyspark.sql import functions as F
    pages = spark.createDataFrame(
        [(1, "http://casino.com/a", "casino"), (2, "http://a.net/x", None)], "page_id bigint, url string, html string")
    plain = sorted(map(tuple, url_filter.judge(pages).collect()))
    for name in ("host", "path", "word", "run", "token", "score", "shape", "n"):
        pages = pages.withColumn(name, F.lit(f"own {name}"))
    assert sorted(map(tuple, url_filter.judge(pages).collect())) == plain
