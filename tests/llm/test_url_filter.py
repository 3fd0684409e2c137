import random

from conftest import got

from ledgerloom.llm import url_filter
from ledgerloom.llm.queries import RULES
from ledgerloom.llm.url_filter import Rule


def by_hand(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fitting = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fitting, key=lambda r: (len(r.host), len(r.path)), default=None)
    return host, path, best and best.key, best.verdict if best else "allow"


URLS = [None, "", "no address", "://", "http://", "http://COM/", "https://Example.com/en/1?x=/fr/", "https://www.example.com/en/2#a", "x://a.b.net/es",
        "x://a.b.net/es/", "ftp://net/fr/x://y.com/", "http://notexample.com/en/", "http://example.com?/en/", "http://É.example.com/en/", "http://example.com./en/",
        "http://user@example.com/en/", "a\nb://x.net/es/"]


def test_verdicts(make):
    pages = make("page_id long, url string, rule int, key string", *[(i, u, 1, "k") for i, u in enumerate(URLS)], (None, URLS[6], 1, "k"), (1, "", 1, "k"))
    wanted = [(i, *by_hand(u, RULES)) for i, u in enumerate(URLS)] + [(None, *by_hand(URLS[6], RULES)), (1, *by_hand("", RULES))]
    found = url_filter.judge(pages, RULES)
    assert got(found) == sorted(wanted, key=repr)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    assert url_filter.judge(pages.limit(0), RULES).collect() == []
    assert {r.verdict for r in url_filter.judge(pages, [], default="block").collect()} == {"block"}


def test_many_rules(make):
    rng = random.Random(4)
    hosts = [".".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    rules = list({r.key: r for r in (Rule(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(["/", "/x", "/x/y"])) for _ in range(60))}.values())
    urls = [f"http://{h}/{rng.choice(['', 'x', 'xx', 'x/y', 'x/z'])}" for h in hosts]
    found = url_filter.judge(make("page_id long, url string", *enumerate(urls)), rules)
    assert got(found) == sorted([(i, *by_hand(u, rules)) for i, u in enumerate(urls)], key=repr)


def test_a_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(3000).selectExpr("CAST(id AS STRING) AS key")
    listed = universe.filter("key % 7 = 0")
    levels = url_filter.cascade(universe, listed, listed.count())
    assert len(levels) > 1
    wrong = universe.filter(url_filter.member(levels, universe["key"]) != (universe["key"].cast("int") % 7 == 0))
    assert wrong.count() == 0
