"""Main text of web pages, by removal of what recurs across a site.

Each page is parsed once, to a tree of elements.  What the roles that the markup itself tells (navigation, header, footer, form,
advert, comments and so on) name is cut, and the rest is written block by block, with the container subtrees around every
piece of text and their hashes.  The hashes are counted per host in Spark; a
subtree that recurs on a fixed number of pages of a host is template and is deleted wherever it stands on that
host, but for headings and paragraphs.  Copies of an article are no template: a subtree that reads like one (it holds
a main heading, an article, or much running text) has to recur on a share of the host's pages, and goes only where it
holds at most half of a page.  The text of a page is put together from the pieces that stand in no template.

Counts are partial sums before their shuffle, so that a host with a third of all pages is no burden.
Templates meet the subtrees of pages by (host, hash): they are broadcast if they are few, else frequent ones are
and only hashes are shuffled; texts are shuffled only if the lists of what goes from each page are too many to broadcast.

Defined cases: a null or empty page has an empty text; so has one without content; a null url has an empty
host, for which nothing is counted; broken and cut-off markup is read as far as it goes; repeated rows are
read each and count each; an empty table gives an empty result; other columns, whatever their names, are ignored."""

from __future__ import annotations

import html as entities
import marshal
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import Stage, join_counted, ship, small
from loomgraph.llm.html_tree import BLOCKS, RAW, SPACE, Node, hash_subtrees, parse
from loomgraph.llm.url_filter import with_host_and_path

#: A subtree is template from so many pages of its host on; one that reads like an article, from such a share of them.
MIN_PAGES, MIN_SHARE = 5, 0.2
#: Words of a block of running text, and of all such blocks of a subtree that reads like an article.
RUNNING, PROSE = 10, 50

#: Elements that can be template.
CONTAINERS = frozenset("div section ul ol dl table aside nav header footer form figure details menu center fieldset address span dialog search".split())
#: Elements without article text.
NEVER = RAW - {"noscript"} | frozenset("head nav footer aside form dialog menu button select fieldset search label noscript".split())
#: Words of class, id or role that tell the same.
ROLES = frozenset("ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar complementary contentinfo widget related recommended share sharing social footer masthead comment comments commentlist disqus discussion reply replies respond pagination pager toolbar skip search login form".split())
#: Words that make a class one of the article's own.
ARTICLE = frozenset("article post entry content story main body text".split())

_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _told(x: Node) -> bool:
    """Whether the markup says that this is no article text."""
    if x.tag in NEVER:
        return True
    if not x.attrs.strip():
        return False
    a = x.attributes()
    if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "").lower():
        return True
    if x.tag in ("article", "main", "body", "html"):
        return bool({w.lower() for w in _WORDS.findall(a.get("class", "") + " " + a.get("id", ""))} & {"comment", "comments", "reply", "ad", "advert", "related", "promo"}) and x.tag == "article"
    for value in (a.get("class", ""), a.get("id", ""), a.get("role", "")):
        for name in value.split():
            words = {w.lower() for w in _WORDS.findall(name)}
            if words & ROLES and not (words & ARTICLE and not words & {"comment", "comments", "ad", "ads", "advert", "footer", "nav", "sidebar", "related", "share"}):
                return True
            if words == {"header"} or words == {"site", "header"} or words == {"page", "header"} or words == {"top", "bar"}:
                return True
    return False


def _cut(root: Node) -> None:
    """Deletes what is told."""
    todo = [root]
    while todo:
        x = todo.pop()
        kept: list[Node | str] = []
        for c in x.children:
            if not isinstance(c, str):
                gone = _told(c) or (c.tag == "header" and not (_inside(c, "article") and _has_heading(c)))
                if gone:
                    kept.append("\x00" if c.tag in BLOCKS else " ")  # still parts the text beside it
                    continue
                todo.append(c)
            kept.append(c)
        x.children = kept


def _inside(x: Node, tag: str) -> bool:
    while x := x.parent:
        if x.tag == tag:
            return True
    return False


def _has_heading(x: Node) -> bool:
    return any(c.tag in ("h1", "h2", "h3") for c in x.walk())


def _roots(root: Node) -> list[Node]:
    """The outermost articles; else main; else everything."""
    for want in (lambda x: x.tag == "article", lambda x: x.tag == "main" or x.attributes().get("role") == "main"):
        found, todo = [], [root]
        while todo:
            x = todo.pop()
            if x is not root and want(x):
                found.append(x)
            else:
                todo += [c for c in reversed(x.children) if not isinstance(c, str)]
        if found:
            return found
    return [root]


class Outline:
    """A page as blocks of pieces (text, what it stands in, what it stands for), with the containers they stand in.

    Containers are numbered, each with the one around it (-1: none), its hash, and whether it reads like an article.  A piece
    that stands for a container is a space where that one goes."""

    def __init__(self, page: str):
        root = parse(page)
        hash_subtrees(root)
        found = _containers(root)
        _cut(root)
        self.blocks: list[list[tuple[str, int, int]]] = [[]]
        self.around: list[int] = []
        self.hashes: list[int] = []
        self.article: list[bool] = []
        numbers: dict[int, int] = {}

        def number(x: Node, around: int) -> int:
            if id(x) not in found:
                return around
            if id(x) not in numbers:
                numbers[id(x)] = len(self.hashes)
                self.around.append(around)
                self.hashes.append(x.hash)
                self.article.append(found[id(x)])
            return numbers[id(x)]

        for r in _roots(root):
            above, x = [], r
            while x := x.parent:
                above.append(x)
            at = -1
            for x in reversed(above):
                at = number(x, at)
            self._open()
            self._read(r, at, number)
        self.blocks = [b for b in self.blocks if b]

    def _open(self) -> None:
        if self.blocks[-1]:
            self.blocks.append([])

    def _read(self, x: Node, at: int, number) -> None:
        """Text by block, in page order."""
        todo: list = [(x, at)]
        while todo:
            x, at = todo.pop()
            if x is None:
                self._open()
            elif isinstance(x, str):
                if x == "\x00":
                    self._open()
                else:
                    self.blocks[-1].append((x, at, -1))
            else:
                own = number(x, at)
                if x.tag in BLOCKS:
                    self._open()
                    todo.append((None, at))
                elif own != at:
                    self.blocks[-1].append(("", at, own))
                todo += [(c, own) for c in reversed(x.children)]


def assembled(blocks: list, around: list[int], hashes: list[int], template) -> str:
    """The text without what stands in containers whose hash is in ``template``."""
    gone: list[bool] = []
    for h, a in zip(hashes, around, strict=True):
        gone.append(h in template or a >= 0 and gone[a])
    out = []
    for block in blocks:
        parts = [(" " if gone[instead] else "") if instead >= 0 else text for text, at, instead in block if at < 0 or not gone[at]]
        if text := SPACE.sub(" ", entities.unescape("".join(parts))).strip():
            out.append(text)
    return "\n\n".join(out)


def _containers(root: Node) -> dict[int, bool]:
    """The subtrees that can be template (by id), and whether they read like an article (those only if they
    hold at most half of the page)."""
    prose: dict[int, int] = {}
    out: dict[int, bool] = {}
    for x in reversed(list(root.walk())):
        n = 0
        own = 0
        for c in x.children:
            if isinstance(c, str):
                own += len(c.split())
            else:
                n += PROSE if c.tag in ("article", "main", "h1") else prose[id(c)]
        prose[id(x)] = n + (own if own >= RUNNING and x.tag not in ("a", "li", "option") and x.tag not in RAW else 0)
        if x.tag in CONTAINERS:
            article = prose[id(x)] >= PROSE
            if not article or x.size <= root.size / 2:
                out[id(x)] = article
    return out


def main_text(page: str, template: frozenset | set = frozenset()) -> str:
    o = Outline(page)
    return assembled(o.blocks, o.around, o.hashes, template)


def outlines(pages: DataFrame) -> DataFrame:
    """page_id (as a string), url, host (its hash), hashes, article and the outline of each page."""

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [Outline(page) for page in pdf.pop("html")]
            pdf["hashes"] = [[h - (1 << 63) for h in o.hashes] for o in found]
            pdf["article"] = [o.article for o in found]
            pdf["outline"] = [marshal.dumps((o.blocks, o.around)) for o in found]
            yield pdf

    pages = with_host_and_path(pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")))
    # Numbers travel as strings: pandas would turn integers with nulls among them to floats.
    pages = pages.select(F.col("page_id").cast("string"), "url", "html", F.when(F.col("host") != "", F.xxhash64("host").cast("string")).alias("host"))
    return pages.mapInPandas(go, "page_id string, url string, host string, hashes array<long>, article array<boolean>, outline binary")


def templates(rows: DataFrame, stage: Stage, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """host, hash, n of the subtrees that are template on a host."""
    known = rows.filter("host is not null")
    each = known.select("host", F.explode(F.array_distinct(F.arrays_zip("hashes", "article"))).alias("x")).select("host", F.col("x.hashes").alias("hash"), F.col("x.article").alias("article"))
    counted = stage.write(each.groupBy("host", "hash").agg(F.count("*").alias("n"), F.max("article").alias("article")).filter(F.col("n") >= min_pages), "counts")
    total = known.groupBy("host").agg(F.count("*").alias("pages"))
    kept = counted.join(small(stage.write(total, "hosts")), "host").filter(~F.col("article") | (F.col("n") >= min_share * F.col("pages")))
    return stage.write(kept.select("host", "hash", "n"), "template")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """page_id, url, text, n_chars for each row."""
    spark = pages.sparkSession
    ship(spark)
    stage = Stage(spark, "html")
    rows = stage.write(outlines(pages).withColumn("row", F.monotonically_increasing_id()), "outlines")
    template = templates(rows, stage, min_pages, min_share)
    held = rows.filter("host is not null").select("row", "host", F.explode(F.array_distinct("hashes")).alias("hash"))
    gone = join_counted(held, template, ["host", "hash"]).groupBy("row").agg(F.collect_list("hash").alias("gone"))  # as many as a page has
    left = rows.join(small(stage.write(gone, "gone")), "row", "left").select("page_id", "url", "hashes", "outline", "gone")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = []
            for hashes, outline, gone in zip(pdf.pop("hashes"), pdf.pop("outline"), pdf.pop("gone"), strict=True):
                blocks, around = marshal.loads(outline)
                texts.append(assembled(blocks, around, hashes.tolist(), frozenset() if gone is None else frozenset(gone.tolist())))
            pdf["text"] = texts
            yield pdf

    out = left.mapInPandas(read, "page_id string, url string, text string")
    return out.withColumn("page_id", F.col("page_id").cast("long")).withColumn("n_chars", F.length("text").cast("long"))
