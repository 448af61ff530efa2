"""URL rules against a plain loop, over one and several digest segments."""

import random
import re

import numpy as np
import pytest

from strata.llm import urlfilter as U

RULE_SCHEMA = "host string, path string, verdict string"


def parse(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def plain(url, rules):
    host, path = parse(url)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else "allow"


def urls():
    return [None, "", "no scheme", "http://", "http://a.org", "http://a.org/", "HTTP://A.B.ORG/x?y#z", "x://example.org/es/1", "http://www.example.org/en/15", "http://example.org/en/2",
            "http://notexample.org/es/", "http://q.com/fr/?a", "http://q.com/de/#f", "http://q.com/es/", "http://com/de/", "http://u:1@com/de/", "a://b://c.org/d", "http://ÄB.org/ü/", "http://x.com/de", "http://..org//", "http://example.org?es/", "http://x.org\n/y", "http://" + "s." * 300 + "org/" + "p" * 5000]


def test_contract_rules(spark):
    rows = [(i, u, "v") for i, u in enumerate(urls())] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    out = U.judge(df, U.build_digest_array(spark.createDataFrame(U.RULES, RULE_SCHEMA)))
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect()), key=str)
    assert got == sorted(((i, *plain(u, U.RULES)) for i, u, _ in rows), key=str)


@pytest.mark.parametrize("per_segment", [7, 100000])
def test_many_rules_in_segments(spark, per_segment):
    rng = random.Random(9)
    rules = {(rng.choice(["", "www.", "m."]) + f"h{rng.randrange(30)}.org", "/" + "x" * rng.randrange(4)): rng.choice(["allow", "block"]) for _ in range(80)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    bad = [(None, "/", "block"), ("", "/", "block"), ("h1.org", None, "block"), ("h2.org", "/", "maybe")]
    array = U.build_digest_array(spark.createDataFrame(rules + bad + rules[:5], RULE_SCHEMA), rules_per_segment=per_segment)
    assert (len(array.segments) > 5) == (per_segment == 7)
    pages = [(i, f"http://{rng.choice(['', 'www.', 'a.m.'])}h{rng.randrange(32)}.org/{'x' * rng.randrange(5)}") for i in range(400)]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(spark.createDataFrame(pages, "page_id long, url string"), array).collect()}
    assert got == {i: plain(u, rules) for i, u in pages}


def test_collisions_are_confirmed(monkeypatch, spark):
    array = U.build_digest_array(spark.createDataFrame(U.RULES, RULE_SCHEMA))
    prober = U.Prober(array)
    segment = prober._map(array.segments[0][0])
    segment["keys"] = np.full_like(segment["keys"], U.digest("other"))
    prober.array = U.DigestArray(array.path, ((array.segments[0][0], 0, 1 << 63),), array.lengths)
    assert prober.probe(["other"]).tolist() == [-1]


def test_no_rules_and_no_rows(spark):
    none = U.build_digest_array(spark.createDataFrame([], RULE_SCHEMA))
    assert U.judge(spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string"), none).first().verdict == "allow"
    assert U.judge(spark.createDataFrame([], "page_id long, url string"), none).count() == 0
    array = U.build_digest_array(spark.createDataFrame([("a.org", "/", "allow"), ("a.org", "/", "block")], RULE_SCHEMA))
    assert U.judge(spark.createDataFrame([(1, "http://A.org/x")], "page_id long, url string"), array, default="block").first().verdict == "block"
