from loomgraph.llm import queries, url_filter


def judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([i for c in "?#" if (i := tail.find(c)) >= 0], default=len(tail))]
    fits = [(len(h + p), len(h), a, h + p) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


URLS = ["http://example.com/en/7", "http://a.EXAMPLE.com/en/78?x=/en/7", "http://example.com/en/", "https://xexample.com/en/7", "http://b.org/es/#f", "http://org/es/", "http://Ä.org/es/a", "net/de/8", None, "", "x://", "http://example.net/de/8", "http://m.example.net/de/9", "http://example.net?/de/8", "http://example.net#/de", "http://com/en", "a://b://com/en/"]


def test_matches_brute_force(spark):
    rows = [(i, u, "html", "h", "p", "r") for i, u in enumerate(URLS + URLS[:3])] + [(None, URLS[0], None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, path string, rule string")
    rules = spark.createDataFrame(queries.RULES, "host string, path string, action string")
    got = sorted((tuple(r) for r in url_filter.filter_urls(pages, rules).collect()), key=str)
    assert got == sorted(((r[0], *judge(r[1], queries.RULES)) for r in rows), key=str)
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.filter_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_filter_has_no_false_negative_and_few_false_positives(spark):
    keys = [f"host{i}.com /p{i}" for i in range(3000)]
    words, blocks = url_filter.build_filter(spark.createDataFrame([(k,) for k in keys], "k string"))
    assert url_filter.passes(keys, words, blocks).all()
    assert url_filter.passes([f"no{i}" for i in range(20_000)], words, blocks).mean() < 0.02


def test_a_longer_list_is_exact(spark):
    rules = [(f"h{i % 50}.com", f"/{i}/", "block" if i % 3 else "allow") for i in range(400)] + [("com", "", "allow"), ("h1.com", "/1/", "allow")]
    urls = [f"http://{s}h{i % 53}.com/{i % 450}/x" for i in range(900) for s in ("", "a.")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.filter_urls(pages, spark.createDataFrame(rules, "host string, path string, action string")).collect()}
    assert got == {i: judge(u, rules) for i, u in enumerate(urls)}
