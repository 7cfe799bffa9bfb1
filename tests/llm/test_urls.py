"""Hosts, paths and rules against a plain reading; splits against all splits; words that mark a site."""

import itertools
import random

import pytest

from docfold.llm import urls
from docfold.llm.common import ready

SCHEMA = "page_id long, url string, html string, rule string"


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    labels = host.split(".")
    fits = [
        (len(h + p), h + p, v)
        for v, h, p in urls.RULES
        if labels[-len(h.split(".")) :] == h.split(".") and path[: len(p)] == p
    ]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    "http://a.com", "http://a.com/", "HTTP://A.COM/x?y#z", "https://www.example.com/en/1", "x://example.com/en/",
    "x://example.com/en", "x://myexample.com/en/2", "x://b.example.com/en/a?b", "http://q.net/es/", "http://net/fr/a",
    "http://q.net/de/", "http://q.net?/es/", "http://q.org/en/#/", "noscheme", "", None, "a://b://c.com/x", "://com/",
    "http://Ä.com/é", "http://a.com#/x", "http://a\n.com/\nx", "http://" + "a" * 5000 + ".org/", "http:///en/",
    "http://www.example.com.net/fr/x", "http://xcom/", "http://.com/", "http://com./",
]


def frame(spark, rows):
    return ready(spark).createDataFrame([(i, u, h, "clash") for i, (u, h) in enumerate(rows)], SCHEMA)


def test_hosts_paths_and_rules(spark):
    got = urls.judge(frame(spark, [(u, None) for u in URLS])).collect()
    assert len(got) == len(URLS)
    for r in got:
        host, path = plain(URLS[r.page_id])
        assert (r.host, r.path) == (host, path)
        rule, verdict = rule_of(host, path)
        assert r.rule == rule
        assert r.verdict == (verdict or ("block" if r.log_odds > 0 else "allow"))


def test_words_decide_the_rest(spark):
    pick = random.Random(3)
    words = ["river", "stone", "garden", "music", "house", "green", "letter"]
    html = "<p class='x'>" + " ".join(pick.choice(words) for _ in range(400)) + "</p>"
    names = lambda: "".join(pick.sample(words, 2))
    rows = [(f"http://{names()}.org/en/{i}", html) for i in range(120)]
    bad = ["casino-gold.org", "goldcasino.org", "bestgoldpills.org", "free-spam-gold.org"]
    rows += [(f"http://{b}/en/{i}", None) for i in range(6) for b in bad]
    got = urls.judge(frame(spark, rows)).collect()
    for r in got:
        assert r.verdict == ("block" if r.page_id >= 120 else "allow"), r
        if r.page_id < 120:
            assert len(r.host_words) == 3 and set(r.host_words[:2]) <= set(words)


def all_splits(name):
    for cuts in itertools.product([0, 1], repeat=max(0, len(name) - 1)):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(name)]
        yield [name[a:b] for a, b in itertools.pairwise(at)]


@pytest.mark.parametrize("name", ["abab", "abcba", "xabyab", "aaaaaaa", "bca"])
def test_viterbi_is_the_best_of_all_splits(name):
    s = urls.Segmenter({"a": 5, "ab": 9, "ba": 2, "abc": 4, "aaa": 1, "b": 3})
    price = lambda words: sum(s.cost.get(w, s.unknown(len(w))) for w in words)
    assert price(s.split(name)) == pytest.approx(min(map(price, all_splits(name))))
    assert "".join(s.split(name)) == name


def test_empty_table(spark):
    assert urls.judge(frame(spark, [])).count() == 0
