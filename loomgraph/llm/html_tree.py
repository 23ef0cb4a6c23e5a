"""A small, forgiving HTML tree: block elements as nodes, everything inline as text."""

from __future__ import annotations

import html as entities
import re

import xxhash

BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody tfoot thead title tr caption ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup.
RAW = frozenset("script style textarea title noscript template iframe svg math canvas object audio video xmp noembed noframes".split())
#: Opening one of these ends an open p.
ENDS_P = BLOCKS - {"head", "html", "body", "legend", "option", "optgroup", "caption", "title", "tr", "tbody", "thead", "tfoot"}
#: Opening one ends an open one of these, up to the container that holds them.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "hash", "size")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.hash = self.size = 0

    def attributes(self) -> dict[str, str]:
        return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(self.attrs)} if self.attrs.strip() else {}

    def walk(self):
        """Below and itself, parents first, in page order."""
        todo = [self]
        while todo:
            x = todo.pop()
            yield x
            todo += [c for c in reversed(x.children) if not isinstance(c, str)]


def parse(text: str, raw_text=frozenset()) -> Node:
    """The tree below a root without a tag.  Inline tags leave no node unless they carry attributes; br and cells are a space."""
    root = here = Node("", "", None)
    at, n = 0, len(text)
    while at < n:
        m = TOKEN.search(text, at)
        if not m:
            here.children.append(text[at:])
            break
        if m.start() > at:
            here.children.append(text[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, attrs = name.lower(), m[3] or m[6] or ""
        if m[1] or m[4]:
            x = here
            while x is not root and x.tag != tag:
                x = x.parent
            if x is not root:
                here = x.parent
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I | re.S).search(text, at) if not attrs.rstrip().endswith("/") or tag not in ("svg", "math") else None
            node = Node(tag, attrs, here)
            here.children.append(node)
            if not attrs.rstrip().endswith("/") or tag not in ("svg", "math"):
                at = end.end() if end else n
            continue
        if tag in ("br", "td", "th"):
            here.children.append(" ")
            continue
        if tag in VOID and tag != "hr":
            continue
        if tag in BLOCKS:
            if tag in ENDS_P:
                x = here
                while x is not root and x.tag != "p" and x.tag not in BLOCKS:
                    x = x.parent
                if x.tag == "p":
                    here = x.parent
            if tag in IMPLIED:
                ended, inside = IMPLIED[tag]
                x = here
                while x is not root and x.tag not in ended and x.tag not in inside:
                    x = x.parent
                if x.tag in ended:
                    here = x.parent
        elif not attrs.strip() or tag == "a":
            continue  # inline: its text belongs to the block
        node = Node(tag, attrs, here)
        here.children.append(node)
        if tag != "hr":
            here = node
    return root


def hash_subtrees(root: Node) -> None:
    """Sets each node's hash, of its tag, class and id and what is below it with white space folded, and its size in characters."""
    for x in reversed(list(root.walk())):
        a = x.attributes()
        parts = [x.tag, a.get("class", ""), a.get("id", "")]
        parts += [SPACE.sub(" ", c).strip() if isinstance(c, str) else f"\x01{c.hash:016x}" for c in x.children]
        x.size = sum(len(c) if isinstance(c, str) else c.size for c in x.children)
        x.hash = xxhash.xxh3_64_intdigest("\x02".join(p for p in parts if p))
