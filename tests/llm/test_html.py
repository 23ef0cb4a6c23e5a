import random
from collections import Counter

import pytest

from loomgraph.llm import common, html_text


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<article><h1>T &amp; &eacute;</h1><p>a<b>b</b> c<br>d<p>e&nbsp;f</article><footer>f", "T & é\n\nab c d\n\ne f"),
        ("<nav>n</nav><p>x</p><script>var a='</p>'</script><style>p{}</style>y", "x\n\ny"),
        ("<body><header>h</header><main><h2>t</h2><div class='share-bar'>s</div><p>u</p><section id=comments><p>no</p></section></main>", "t\n\nu"),
        ("<article><header><h1>t</h1></header><form><p>f</p></form><aside>a</aside><ul><li>1<li>2</ul></article>", "t\n\n1\n\n2"),
        ("<article><p>a<!-- x --> b</p><div hidden>h</div><p class='article-content'>c</p></article>", "a b\n\nc"),
        ("<article><p>cut off <a href='x", "cut off"),
        ("<article><p>1 < 2 & 3</p><table><tr><td>a<td>b</table></article>", "1 < 2 & 3\n\na b"),
        ("<title>t</title>", ""),
        ("", ""),
        ("<p>" * 3000 + "deep", "deep"),
        ("<div>" * 3000 + "deep", "deep"),
    ],
)
def test_main_text(page, want):
    assert html_text.main_text(page) == want


def test_site_templates_go_and_paragraphs_stay(spark, monkeypatch):
    box, note = "<div><p>Read our other stories today</p><ul><li>one</li></ul></div>", "<p>Recurring line of the article.</p>"
    pages = [(i, f"http://a.com/{i}", f"<body>{box}<div><h1>Title {i}</h1>{note}<p>Text number {i} goes on and on for a while here.</p></div></body>") for i in range(8)]
    pages += [(20, "http://b.com/1", pages[0][2]), (21, None, pages[0][2]), (22, "http://a.com/x", None), (None, "http://a.com/y", ""), (23, "http://a.com/0", pages[0][2])]
    df = spark.createDataFrame([(*p, "h", "t") for p in pages], "page_id long, url string, html string, host string, text string")
    for least in (0, 1 << 24):
        monkeypatch.setattr(common.few, "__defaults__", (least,))
        monkeypatch.setattr(common.small, "__defaults__", (least,))
        got = {r["page_id"]: r["text"] for r in html_text.extract(df).collect()}
        assert len(got) == len(pages)
        for i in range(8):
            assert got[i] == f"Title {i}\n\nRecurring line of the article.\n\nText number {i} goes on and on for a while here."
        assert got[20].startswith("Read our other") and got[21] == got[20] and got[22] == "" and got[23] == got[0]
    rows = html_text.extract(df).filter("page_id = 0").head()
    assert rows["n_chars"] == len(rows["text"])
    assert html_text.extract(df.limit(0)).count() == 0


def test_templates_of_a_small_share_of_a_large_host_go(spark, monkeypatch):
    box = "<div><p>Read the other stories</p><ul><li>one</li><li>two</li></ul></div>"
    copied = "<div><h1>Copied</h1><p>" + "This article stands under several addresses of the site. " * 8 + "</p></div>"
    menu = "<div><ul>" + "".join(f"<li>section {i}</li>" for i in range(60)) + "</ul></div>"
    pages = [(i, f"<body><div><h1>Title {i}</h1>{box if i < 6 else ''}<p>Text number {i}.</p></div>{menu if 6 <= i < 12 else ''}</body>") for i in range(100)]
    pages += [(200 + i, f"<body>{copied}<p>{i}</p></body>") for i in range(6)]
    df = spark.createDataFrame([(i, f"http://a.com/{i}", h) for i, h in pages], "page_id long, url string, html string")
    for least in (0, 1 << 24):
        monkeypatch.setattr(common.few, "__defaults__", (least,))
        monkeypatch.setattr(common.small, "__defaults__", (least,))
        got = {r["page_id"]: r["text"] for r in html_text.extract(df).collect()}
        assert all(got[i] == f"Title {i}\n\nText number {i}." for i in range(100))
        assert all(got[200 + i].startswith("Copied\n\nThis article") for i in range(6))


def site(rng, host, n):
    """Pages of a site without articles or telling names: blocks that recur, each with its own class, around and inside of the text."""
    words = lambda k: " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(50)) for _ in range(k))
    boxes = [f"<div class='c{i}'><div><p>{words(5)}</p></div><ul>" + "".join(f"<li><a href='/{j}'>{words(2)}</a></li>" for j in range(4)) + "</ul></div>" for i in range(6)]
    spans = [f"<span class='s{i}'>{words(2)}</span>" for i in range(3)]
    pages = []
    for i in range(n):
        own = [f"<p>{words(12)}</p>" if rng.random() < 0.8 else f"<p>{words(3)} {rng.choice(spans)} {words(3)}</p>" for _ in range(rng.randint(2, 5))]
        box = [b for b in boxes if rng.random() < 0.35]
        k = rng.randrange(len(own))
        body = "".join(box[:2]) + f"<div class='x9'><h1>{words(4)}</h1>" + "".join(own[:k]) + "".join(box[2:3]) + "".join(own[k:]) + "</div>" + "".join(box[3:])
        pages.append((f"http://{host}/{i}", f"<html><body><div class='z'>{body}</div></body></html>"))
    return pages


def test_templates_of_generated_sites_equal_a_brute_force_count(spark):
    """Where no markup tells what is article, the counted subtrees alone decide; without them, their text stays."""
    rng = random.Random(3)
    pages = [p for h, n in enumerate((4, 12, 30, 40)) for p in site(rng, f"h{h}.com", n)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extract(df).collect()}
    seen, total = Counter(), Counter()
    for url, page in pages:
        host, o = url.split("/")[2], html_text.Outline(page)
        total[host] += 1
        for h, article in set(zip(o.hashes, o.article)):
            seen[host, h, article] += 1
    changed = 0
    for i, (url, page) in enumerate(pages):
        host = url.split("/")[2]
        template = {h for (at, h, article), n in seen.items() if at == host and n >= 5 and (not article or n >= 0.2 * total[host])}
        assert got[i] == html_text.main_text(page, template)
        changed += got[i] != html_text.main_text(page)
    assert changed > 30
    blocks = Counter((pages[i][0].split("/")[2], b) for i in got for b in set(got[i].split("\n\n")))
    assert max(blocks.values()) < 5  # nothing that recurs is left
