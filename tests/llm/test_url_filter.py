import random
import re
from collections import Counter

import pytest

from corpusloom.llm import url_filter
from corpusloom.llm.queries import RULES
from corpusloom.llm.url_filter import judge_urls

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def judged(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
    fitting = [
        (len(h + p), len(h), v, h + p) for h, p, v in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fitting, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def urls():
    draw = random.Random(3)
    hosts = ["net", "example.net", "a.example.net", "Example.NET", "xexample.net", "example.com", "m.example.com", "x.org", "org", "é.net", "a..net", ".net", "net."]
    paths = ["", "/", "/en/", "/en", "/de/1", "/fr/?q=://x/", "/EN/", "?a=/en/", "#/en/", "/en/../de/"]
    made = [f"{draw.choice(['http', 'https', ''])}://{draw.choice(hosts)}{draw.choice(paths)}" for _ in range(200)]
    return made + [None, "", "example.net/en/", "://", "http://", "x://y://net/", "http://" + "a." * 300 + "net/en/", "http:///en/\nx"] * 2


@pytest.mark.parametrize("block", [200_000, 1])
def test_equal_to_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(url_filter, "BLOCK_RULES", block)
    rules = [*RULES, ("a.example.net", "", "block"), ("example.net", "/e", "block"), ("xexample.net", "/", "allow")]
    rows = [(i % 100 if i % 7 else None, u, "host", "rule") for i, u in enumerate(urls())]
    pages = spark.createDataFrame(rows, "page_id int, url string, host string, rule string")
    spec = spark.createDataFrame([*rules, (None, "/", "block")], "host string, path string, verdict string")
    found = Counter(tuple(r) for r in judge_urls(pages, spec).collect())
    assert found == Counter((i, *judged(u, rules)) for i, u, _, _ in rows)


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/")], "page_id int, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r) for r in judge_urls(pages, none).collect()] == [(1, "a.net", "/", None, "allow")] * 2
    assert judge_urls(pages.limit(0), none).count() == 0
