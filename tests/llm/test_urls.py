import math
import random
from collections import Counter, defaultdict

import pytest

from siftline.llm import url_filter as U

ODD = [None, "", "no scheme/org/", "HTTP://Sub.Example.ORG/en/12?x#y", "http://example.org/en/1", "http://example.org/es/1/../",
       "http://org/", "http://org", "http://a.org?x=/", "x://://org/a", "http://notcom/fr/", "http://b.com/fr/é?q", "http://b.com/fr",
       "http://b.com/de/1#/fr/", "http://C.com/DE/1", "http://Ünï.org/a b", "\nhttp://q.org/a\nb", "http://z.net/" + "a/" * 5000]


@pytest.fixture(scope="module")
def urls():
    rng = random.Random(1)
    made = [f"http://{rng.choice(['blog.', 'www.', ''])}{rng.choice(['tion', 'erth', 'spam'])}.example.{rng.choice(['org', 'com', 'net'])}"
            f"/{rng.choice(['en', 'fr', 'de', 'es'])}/{rng.randrange(400)}" for _ in range(500)]
    return ODD + made + made[:50]


def brute_parse(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    cut = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:cut]


def brute_rule(host, path):
    fit = [(r, v) for r, v in U.RULES for h, _, p in [r.partition("/")]
           if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fit, key=lambda r: len(r[0]), default=(None, None))


def grams(url):
    plain = "".join(c.lower() if "A" <= c <= "Z" else c if " " <= c <= "~" else U.OTHER for c in url or "")
    s = U.BEFORE * 3 + plain + U.END
    return [s[k:k + 4] for k in range(len(plain) + 1)]


def brute_ratio(train):
    """{side: probability of a window's last character}."""
    def model(rows):
        counts = [defaultdict(Counter) for _ in range(4)]
        for url in rows:
            for g in grams(url):
                for k in range(4):
                    counts[k][g[3 - k:3]][g[3]] += 1

        def p(g):
            q = 1 / U.SYMBOLS
            for k in range(4):
                c = counts[k].get(g[3 - k:3])
                if c:
                    q = (c[g[3]] + len(c) * q) / (sum(c.values()) + len(c))
            return q
        return p
    yes, no = (model(train[s]) for s in ("allow", "block"))
    return lambda g: round(1e6 * (math.log(yes(g)) - math.log(no(g))))


def test_equals_brute_force(spark, urls):
    df = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(urls)], "page_id bigint, url string, html string, gram string").repartition(3)
    got = {r.page_id: r for r in U.judged(df).collect()}
    kept_out = {r.page_id for r in df.selectExpr("page_id", "pmod(xxhash64(url), 5) = 0 AS k").filter("k").collect()}
    assert len(got) == len(urls)
    train = defaultdict(list)
    for k, u in enumerate(urls):
        host, path = brute_parse(u)
        rule, verdict = brute_rule(host, path)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule), u
        if verdict:
            assert got[k].verdict == verdict
            if k not in kept_out:
                train[verdict].append(u)
    ratio = brute_ratio(train)
    scores = {k: sum(map(ratio, grams(u))) / len(grams(u)) / 1e6 for k, u in enumerate(urls)}
    for k in got:
        assert got[k].score == pytest.approx(scores[k], abs=3e-6)
    free = [r for r in got.values() if r.rule is None]
    allowed, blocked = ([r.score for r in free if r.verdict == v] for v in ("allow", "block"))
    assert allowed and blocked and min(allowed) > max(blocked)


def test_shuffled_table_and_empty_tables(spark, urls):
    df = spark.createDataFrame([(k % 90, u) for k, u in enumerate(urls)], "page_id bigint, url string")
    key = lambda r: (r.page_id, r.host, r.path, r.rule or "", r.verdict, r.score)
    assert sorted(map(key, U.judged(df).collect())) == sorted(map(key, U.judged(df, broadcast_rows=0).collect()))
    assert U.judged(df.limit(0)).count() == 0
    alone = U.judged(df.filter("url IS NULL")).collect()
    assert [(r.host, r.path, r.rule) for r in alone] == [("", "", None)] and alone[0].verdict in ("allow", "block")
