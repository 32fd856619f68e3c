import random

from tempestry.llm import urls
from tempestry.llm.queries import QUERIES, SQL
from tests.llm.cases import SF
from tests.oracle import compare, connect


def test_sql(spark):
    assert compare(QUERIES["op6_url_digests"](spark, SF), connect(SF), SQL["op6_url_digests"]) > 0


def slow(url, rules, otherwise="allow"):
    host, path = urls.host_and_path(url)
    best = None
    for verdict, rule in rules:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            if best is None or (len(rule), len(h)) > (len(best[1]), len(best[1].partition("/")[0])):
                best = (verdict, rule)
    return (host, path, best[1] if best else None, best[0] if best else otherwise)


AWKWARD = [
    None, "", "http://", "no scheme/com/", "HTTP://Example.COM/en/x?y#z", "http://example.com", "http://example.com/en",
    "x://www.example.com/en/", "http://notexample.com/en/", "http://a.b.example.com/en/?q=http://net/es/", "http://.net/es/",
    "http://net/es/a", "http://x.net#/es/", "http://com/", "a://b://com/", "http://É.com/ü", "http://x.com:80/en/", "http://" + "a." * 3000 + "net/fr/" + "p" * 5000,
]


def table(spark, addresses):
    rows = [(i if i % 5 else None, u, "<p>", "r", 1) for i, u in enumerate(addresses)]
    return spark.createDataFrame(rows + rows[:3], "page_id long, url string, html string, rule string, host long")


def test_awkward_addresses_by_both_ways(spark):
    pages = table(spark, AWKWARD)
    want = sorted(((r.page_id, *slow(r.url, urls.RULES)) for r in pages.collect()), key=str)
    got = urls.judge_urls(pages)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(map(tuple, got.collect()), key=str) == want
    rules = spark.createDataFrame(urls.RULES, "verdict string, rule string")
    assert sorted(map(tuple, urls.judge_by_join(pages, rules).collect()), key=str) == want
    assert urls.judge_urls(pages.limit(0)).count() == 0


def test_long_lists(spark):
    r = random.Random(1)
    word = lambda: r.choice(["a", "b", "cd", "e"])
    rules = [(r.choice(["allow", "block"]), f"{word()}.{word()}/{word() * r.randint(0, 2)}") for _ in range(300)]
    rules = list(dict((rule, (v, rule)) for v, rule in rules).values())
    addresses = [f"h://{word()}.{word()}.{word()}/{word()}{word()}/" for _ in range(300)]
    got = urls.judge_urls(table(spark, addresses), rules, otherwise="block")
    want = sorted((slow(u, rules, "block") for u in addresses + addresses[:3]), key=str)
    assert sorted((tuple(x)[1:] for x in got.collect()), key=str) == want


def test_equal_digests_are_told_apart_by_the_strings(tmp_path, monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda s: len(s))
    place = lambda name: tmp_path / f"{name}.npy"
    urls.DigestArray.write([("block", "a.com/"), ("allow", "b.com/"), ("block", "c.com/")], place)
    array = urls.DigestArray(place)
    found = array.find([b"b.com/", b"c.com/", b"d.com/", b"a.com/x"])
    assert [array.rule(i) if i >= 0 else None for i in found] == [b"b.com/", b"c.com/", None, None]
