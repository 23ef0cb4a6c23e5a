"""Turtle as a data source: spark.read.format("turtle").load(path), and the parser behind it.

Prefixes, bases, ``a``, ``;`` and ``,`` lists, plain, long, numeric and boolean literals with language or datatype, and
comments are understood.  Blank nodes and collections are not, and raise."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import urljoin

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from loomgraph.sources.schemas import TRIPLE

RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
XSD = "http://www.w3.org/2001/XMLSchema#"

_TOKEN = re.compile(
    r"""(?P<space>[ \t\r\n]+|\#[^\n]*)
      | <(?P<iri>[^<>"{}|^`\\\x00-\x20]*)>
      | (?P<long>\"{3}(?:(?:\"|\"\")?(?:[^\"\\]|\\.))*\"{3}|'{3}(?:(?:'|'')?(?:[^'\\]|\\.))*'{3})
      | (?P<text>"(?:[^"\\\n\r]|\\.)*"|'(?:[^'\\\n\r]|\\.)*')
      | @(?P<at>[A-Za-z]+(?:-[A-Za-z0-9]+)*)
      | \^\^(?P<type>)
      | (?P<number>[+-]?(?:[0-9]+\.[0-9]*[eE][+-]?[0-9]+|\.?[0-9]+[eE][+-]?[0-9]+|[0-9]*\.[0-9]+|[0-9]+))
      | (?P<blank>_:|[\[\]()])
      | (?P<name>(?:[\w](?:[\w.-]*[\w-])?)?:(?:(?:[\w:]|%[0-9A-Fa-f]{2}|\\[-_~.!$&'()*+,;=/?\#@%])(?:(?:[\w.:-]|%[0-9A-Fa-f]{2}|\\[-_~.!$&'()*+,;=/?\#@%])*(?:[\w:-]|%[0-9A-Fa-f]{2}|\\[-_~.!$&'()*+,;=/?\#@%]))?)?)
      | (?P<word>[A-Za-z]+)
      | (?P<mark>[.;,])""",
    re.X | re.S,
)
_ESCAPES = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}


class TurtleError(ValueError):
    pass


def _unescape(s: str) -> str:
    return re.sub(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "uU" and len(m[1]) > 1 else _ESCAPES[m[1]], s, flags=re.S)


def _tokens(text: str) -> Iterator[tuple[str, str]]:
    at = 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise TurtleError(f"cannot read {text[at : at + 30]!r} at character {at}")
        at = m.end()
        if m.lastgroup == "blank":
            raise TurtleError("blank nodes and collections are not supported")
        if m.lastgroup != "space":
            yield m.lastgroup, m[m.lastgroup]
    yield "end", ""


def parse(text: str, base: str = "") -> list[tuple[str, str, str, bool, str | None, str | None]]:
    """Rows of the triple schema."""
    prefixes: dict[str, str] = {}
    tokens, out = list(_tokens(text)), []
    i = 0

    def fail(what: str):
        raise TurtleError(f"{what} expected, not {tokens[i][1]!r}")

    def iri() -> str:
        nonlocal i
        kind, value = tokens[i]
        i += 1
        if kind == "iri":
            value = _unescape(value)
            return value if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", value) or not base else urljoin(base, value)
        if kind == "name":
            prefix, local = value.split(":", 1)
            if prefix not in prefixes:
                raise TurtleError(f"unknown prefix {prefix!r}")
            return prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)
        i -= 1
        return fail("an IRI")

    def mark(wanted: str) -> bool:
        nonlocal i
        if tokens[i] == ("mark", wanted):
            i += 1
            return True
        return False

    def value() -> tuple[str, bool, str | None, str | None]:
        nonlocal i
        kind, v = tokens[i]
        if kind in ("text", "long"):
            i += 1
            v = _unescape(v[3:-3] if kind == "long" else v[1:-1])
            if tokens[i][0] == "at":
                i += 1
                return v, False, tokens[i - 1][1].lower(), None
            if tokens[i][0] == "type":
                i += 1
                return v, False, None, iri()
            return v, False, None, None
        if kind == "number":
            i += 1
            return v, False, None, XSD + ("double" if "e" in v.lower() else "decimal" if "." in v else "integer")
        if kind == "word" and v in ("true", "false"):
            i += 1
            return v, False, None, XSD + "boolean"
        return iri(), True, None, None

    while tokens[i][0] != "end":
        kind, word = tokens[i]
        if kind in ("at", "word") and word.lower() in ("prefix", "base"):
            i += 1
            if word.lower() == "prefix":
                if tokens[i][0] != "name" or not tokens[i][1].endswith(":"):
                    fail("a prefix")
                name = tokens[i][1][:-1]
                i += 1
                prefixes[name] = iri()
            else:
                base = iri()
            if kind == "at" and not mark("."):
                fail("'.'")
            continue
        subject = iri()
        while True:
            if tokens[i] == ("word", "a"):
                i, predicate = i + 1, RDF_TYPE
            else:
                predicate = iri()
            while True:
                out.append((subject, predicate, *value()))
                if not mark(","):
                    break
            ended = False
            while mark(";"):
                ended = True
            if not ended or tokens[i] == ("mark", "."):
                break
        if not mark("."):
            fail("'.'")
    return out


class _Reader(DataSourceReader):
    def __init__(self, files: list[tuple[str, str]], base: str):
        self.files, self.base = files, base

    def partitions(self):
        return [InputPartition(f) for f in self.files]

    def read(self, partition):
        yield from parse(partition.value[1], self.base)


class TurtleSource(DataSource):
    """Option ``text`` holds the document itself (as ``read_turtle`` passes it); ``base`` resolves relative IRIs."""

    @classmethod
    def name(cls) -> str:
        return "turtle"

    def schema(self) -> str:
        return TRIPLE

    def reader(self, schema):
        text = self.options.get("text")
        if text is None:
            with open(self.options["path"].removeprefix("file:"), encoding="utf-8") as f:
                text = f.read()
        return _Reader([(self.options.get("path", ""), text)], self.options.get("base", ""))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TurtleSource)


def read_turtle(spark: SparkSession, paths: str | list[str], base: str = "") -> DataFrame:
    """Triples of whole files in any store that Spark reads; a file is parsed in one task."""
    import pandas as pd

    def go(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for text in pdf["value"]:
                yield pd.DataFrame(parse(text, base), columns=["s", "p", "o", "o_is_iri", "lang", "dtype"])

    return spark.read.text(paths, wholetext=True).mapInPandas(go, TRIPLE)
