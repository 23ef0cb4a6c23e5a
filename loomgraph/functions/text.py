"""Column functions on text: slugs, cleaning, names, literals, labels."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it, with the four separators that Unicode leaves out; spelled out, as Java's own class of Unicode is slow.
#: Java tries every range of a class on a letter; what it is met with here turns most letters away after two.
SPACE = r"[\x00-\x20\x85-\u3000&&[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
_U = "(?U)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(F.regexp_replace(_col(c), f"{_U}^{SPACE}+", ""), f"{_U}{SPACE}+$", "")


def collapse(c: Column | str) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(_col(c), f"{_U}{SPACE}+", " ")


def flatten(c: Column | str) -> Column:
    return strip(collapse(c))


def slugify(c: Column | str, series: str | None = None) -> Column:
    """File name to slug; ``series`` is a pattern for a leading series title that is dropped."""
    c = F.regexp_replace(_col(c), r"\.md$", "")
    if series:
        c = F.regexp_replace(c, f"^(?:{series})", "")
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once: an array of one holds it, where a plain column would be written out at every use."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _cleaned(c: Column | str) -> Column:
    """clean_text before its runs of white space are settled.  A pattern is tried only where a character that it needs is there."""
    steps = [("](", r"\[([^\]]+)\]\([^)]*\)", "$1"), ("<", "<[^>]+>", " "), ("&", "&[a-z]+;", " "), ("\xa0", r"\xa0", " "), (">", rf"^{SPACE}*>{SPACE}?", "")]
    step = lambda needs, pattern, by: lambda x: F.when(x.contains(needs), F.regexp_replace(x, pattern, by)).otherwise(x)
    return reduce(lambda c, s: bound(c, step(*s)), steps, _col(c))


def clean_text(c: Column | str) -> Column:
    """Links to labels; tags, named references and no-break spaces to spaces; one leading quote mark dropped (of the
    first line only); runs of spaces and tabs to one space; stripped."""
    return strip(F.regexp_replace(_cleaned(c), "[ \t]+", " "))


def clean_words(c: Column | str) -> Column:
    """The words of a cleaned text: what lies between white space."""
    return F.array_remove(F.split(_cleaned(c), f"{SPACE}+"), "")


def clean_heading(c: Column | str) -> Column:
    return clean_text(F.regexp_replace(_col(c), rf"{_U}^#{{1,6}}{SPACE}+", ""))


def norm_name(c: Column | str) -> Column:
    """A name for matching: lower case, no leading article, ASCII letters, digits and single spaces only."""
    c = F.regexp_replace(F.lower(_col(c)), rf"{_U}^the{SPACE}+", "")
    return F.trim(F.regexp_replace(F.regexp_replace(c, "[^a-z0-9 ]", ""), " +", " "))


def chunk_id(slug: Column | str, seq: Column | str) -> Column:
    return F.format_string("%s::%04d", _col(slug), _col(seq))


def batch_id(slug: Column | str, n: Column | str) -> Column:
    return F.format_string("%s__%03d", _col(slug), _col(n))


def token_estimate(n_words: Column | str) -> Column:
    """Words times 1.3, halves to even."""
    return F.bround(_col(n_words) * F.lit(1.3)).cast("int")


def word_budget(tokens: int, overlap: int) -> tuple[int, int]:
    """Words of a window, and of its overlap, for so many tokens."""
    return max(40, int(tokens / 1.3)), max(0, int(overlap / 1.3))


def doc_of_chunk(c: Column | str) -> Column:
    """The document of a chunk id; null for ids without one."""
    return F.when(_col(c).contains("::"), F.substring_index(_col(c), "::", 1))


def local_name(iri: Column | str) -> Column:
    return F.substring_index(F.substring_index(_col(iri), "#", -1), "/", -1)


def local_in(iri: Column | str, base: str) -> Column:
    """What follows the base, or null."""
    return F.when(_col(iri).startswith(base), F.substring(_col(iri), len(base) + 1, 1 << 20))


def _capital(p: Column) -> Column:
    return F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 20))


def camel_local(name: Column | str) -> Column:
    """A local name from a name: its ASCII letters and digits in camel case, at most 60 characters."""
    joined = F.array_join(F.transform(F.regexp_extract_all(_col(name), F.lit("[A-Za-z0-9]+"), F.lit(0)), _capital), "")
    joined = F.when(joined == "", F.lit("Entity")).otherwise(joined)
    return F.substring(F.when(joined.rlike("^[0-9]"), F.concat(F.lit("E"), joined)).otherwise(joined), 1, 60)


def pack_local(slug: Column | str) -> Column:
    """A local name for a pack; only first letters change case."""
    parts = F.filter(F.split(_col(slug), "[^A-Za-z0-9]+"), lambda p: p != "")
    return F.concat(F.lit("Book_"), F.array_join(F.transform(parts, _capital), ""))


def literal(c: Column | str, fold: bool = True) -> Column:
    """A quoted Turtle literal on one line; ``fold`` collapses white space, else only newlines become spaces."""
    c = F.replace(F.replace(_col(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    c = flatten(c) if fold else strip(F.translate(c, "\n", " "))
    return F.concat(F.lit('"'), c, F.lit('"'))


def title_of(text: Column | str, slug: Column | str) -> Column:
    """The first line as a heading if the text begins with one, else the slug."""
    first = F.regexp_extract(_col(text), "^[^\n\r]*", 0)
    return F.when(strip(text).startswith("#"), clean_heading(first)).otherwise(_col(slug))


def status_of(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", 1)


def breadcrumb(headings: Column | str) -> Column:
    """The last three headings."""
    h = _col(headings)
    last = F.when(F.size(h) > 3, F.slice(h, -3, 3)).otherwise(h)
    return F.when(F.coalesce(F.size(h), F.lit(0)) > 0, F.array_join(last, " › ")).otherwise(F.lit("(root)"))


def snippet(c: Column | str, n: int = 240) -> Column:
    return F.substring(collapse(c), 1, n)


def fact_line(label: Column | str, tags: Column | str, summary: Column | str) -> Column:
    t = _col(tags)
    return F.concat(_col(label), F.lit(" ("), F.when(F.size(t) > 0, F.array_join(t, "/")).otherwise(F.lit("entity")), F.lit("): "), F.coalesce(_col(summary), F.lit("")))
