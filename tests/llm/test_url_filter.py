import random
import re

import numpy as np

from shoplens.llm.queries import SITE_RULES
from shoplens.llm.url_filter import ALLOW, BLOCK, GlobRule, ShiftAnd, _elements, host_words, judge_urls, parts, site_rule


def _pattern(glob):
    forms = {"any": ".", "run": "[^/?]*", "all": ".*"}
    return re.compile("".join(forms.get(kind) or re.escape(c) for kind, c in _elements(glob)), re.S)


def test_automaton_equals_regular_expressions():
    rng = random.Random(3)
    globs = ["".join(rng.choice("**??/.abc\\é") for _ in range(rng.randint(0, 9))) for _ in range(120)]
    texts = ["".join(rng.choice("/?.abc*\\xé\U0001f600") for _ in range(rng.randint(0, 11))) for _ in range(1500)]
    machine = ShiftAnd(globs)
    assert machine.words > 2  # patterns cross word borders
    state = machine.run(texts)
    hits = 0
    for k, g in enumerate(globs):
        word, bit = divmod(machine.final[k], 64)
        got = ((state[:, word] >> np.uint64(bit)) & np.uint64(1)).astype(bool)
        want = [_pattern(g).fullmatch(t) is not None for t in texts]
        assert got.tolist() == want, g
        hits += sum(want)
    assert hits > 500


def _plain(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = re.split("[#]", url.split("://", 1)[1])[0].split("?")[0]
        host, path = re.match("([^/]*)(.*)", rest, re.S).groups()
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in rules if ("." + host).endswith("." + h) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None


URLS = [None, "", "no scheme", "http://", "http:///x", "HTTP://Example.ORG/es/1", "http://example.org", "http://example.org/", "https://a.b.example.org/en/1x",
        "http://notexample.org/es/", "http://x.com/fr/", "http://x.com/de/?u=/fr/", "http://com/de/", "http://.com/de/", "http://x.com:80/de/",
        "http://org?/", "http://x.y#.org/", "http://a.net/b.org/", "http://a.net/?x=.example.org/es/", "ftp://u@h.org/es/://x.com/de/",
        "http://ÀB.org/É", "http://x.com/de/\n\U0001f600", "http://spam-farm.net", "http://x.net/spam", "http://SPAM.org/a", "a://b://c.org/", "http://x.com/de"]


def test_site_rules_and_words(spark):
    rules = [site_rule(*r) for r in SITE_RULES] + host_words(BLOCK, ["spam"])
    long = "http://long.org/es/" + "x" * 200_000
    urls = URLS + [long, URLS[5], URLS[5]]
    df = spark.createDataFrame([(k, u, "host", "rule") for k, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    got = {r.page_id: r for r in judge_urls(df.repartition(3), rules).collect()}
    assert len(got) == len(urls)
    for k, u in enumerate(urls):
        host, path, rule, verdict = _plain(u, SITE_RULES)
        r = got[k]
        assert (r.host, r.path, r.rule) == (host, path, rule), u
        assert r.verdict == (verdict or ("block" if "spam" in host else "allow")), u
    assert got[22].glob == "*spam*" and got[24].verdict == ALLOW


def test_rank_then_length_then_block(spark):
    rules = [GlobRule("**a**", ALLOW, "one"), GlobRule("**ab*", BLOCK, "two"), GlobRule("**ba*", ALLOW, "three"), GlobRule("**c**", BLOCK, "four", 1)]
    df = spark.createDataFrame([(1, "x://a"), (2, "x://ab"), (3, "x://aba"), (4, "x://c"), (5, "x://ca"), (None, None)], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in judge_urls(df, rules).collect()}
    assert got == {1: ("one", ALLOW), 2: ("two", BLOCK), 3: ("two", BLOCK), 4: ("four", BLOCK), 5: ("one", ALLOW), None: (None, ALLOW)}
    assert judge_urls(df.filter("false"), rules).count() == 0
    assert judge_urls(df, [], default=BLOCK).filter("verdict = 'block'").count() == 6


def test_no_shuffle(spark):
    df = spark.createDataFrame([(1, "x://a")], "page_id long, url string")
    assert "Exchange" not in judge_urls(df, host_words(BLOCK, ["x"]))._jdf.queryExecution().executedPlan().toString()


def test_parts_keep_the_query():
    assert parts("http://A.b/c?d#e") == ("a.b", "/c", "?d") and parts("x") == ("", "", "")
