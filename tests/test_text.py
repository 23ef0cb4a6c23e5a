"""Column functions, with the cases a quick version gets wrong."""

import re

import pytest
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.functions import vectors as V


def one(spark, column, **values):
    rows = spark.createDataFrame([tuple(values.values())], list(values))
    return rows.select(column.alias("x")).head()["x"]


def test_token_estimate_rounds_halves_to_even(spark):
    got = [r[0] for r in spark.range(0, 2000).select(T.token_estimate(F.col("id"))).collect()]
    assert got == [round(n * 1.3) for n in range(2000)]


@pytest.mark.parametrize(("n", "want"), [(0, "a::0000"), (12345, "a::12345")])
def test_chunk_ids_are_padded_not_cut(spark, n, want):
    assert one(spark, T.chunk_id("s", "n"), s="a", n=n) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("> a\n> b", "a\n> b"),  # the first line only
        ("[x](http://y) <b>z</b>&nbsp;&#65;", "x z &#65;"),
        ("\xa0a\t\tb\xa0", "a b"),
        ("", ""),
    ],
)
def test_clean_text(spark, raw, want):
    assert one(spark, T.clean_text("s"), s=raw) == want


@pytest.mark.parametrize(("raw", "want"), [("The  House\tof É", "houseof"), ("the", "the"), ("A-B c", "ab c"), ("The Gift", "gift")])
def test_norm_name(spark, raw, want):
    assert one(spark, T.norm_name("s"), s=raw) == want


def test_slugify(spark):
    assert one(spark, T.slugify("s", r"Series\s*\d*e?\s*-\s*"), s="Series 5e - Houses & Homes.md") == "houses-homes"
    assert one(spark, T.slugify("s"), s="-Ü-") == ""


def test_camel_and_pack_locals(spark):
    assert one(spark, T.camel_local("s"), s="pilum of fire") == "PilumOfFire"
    assert one(spark, T.camel_local("s"), s="5th é") == "E5th"
    assert one(spark, T.camel_local("s"), s="é") == "Entity"
    assert one(spark, T.pack_local("s"), s="city-gUILD_2") == "Book_CityGUILD2"


def test_breadcrumb_of_short_and_long_paths(spark):
    assert one(spark, T.breadcrumb("h"), h=["a", "b"]) == "a › b"
    assert one(spark, T.breadcrumb("h"), h=["a", "b", "c", "d"]) == "b › c › d"
    assert one(spark, T.breadcrumb(F.array().cast("array<string>")), h=1) == "(root)"


def test_literal(spark):
    assert one(spark, T.literal("s"), s=' a "b"\\\r\n c ') == '"a \\"b\\"\\\\ c"'


def test_title(spark):
    assert one(spark, T.title_of("t", "s"), t="# Big  *t*\nx", s="slug") == "Big *t*"
    assert one(spark, T.title_of("t", "s"), t="\n# Late", s="slug") == ""
    assert one(spark, T.title_of("t", "s"), t="plain", s="slug") == "slug"


def test_grams_guard_short_texts(spark):
    for text in ("", "a", "a b c", "É x-9"):
        toks = re.findall("[a-z0-9]+", text.lower())
        want = toks + [f"{a}_{b}" for a, b in zip(toks, toks[1:])]
        assert one(spark, V.grams(V.tokens("s")), s=text) == want


def test_dot_refuses_other_dimensions(spark):
    with pytest.raises(Exception, match="different dimensions"):
        one(spark, V.dot("a", "b"), a=[1.0, 2.0], b=[1.0])


def test_zero_vector_stays(spark):
    assert one(spark, V.l2_normalize("a"), a=[0.0, 0.0]) == [0.0, 0.0]


def test_white_space_turns_letters_away_soon(spark):
    """anti_curated and all else on chunks: each of ten ranges was tried on every letter.  The characters are those of Python's isspace."""
    rows = spark.range(0, 0x10000).filter("id not between 55296 and 57343").select("id", F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c"))
    for flags in ("", "(?U)"):
        got = {r["id"] for r in rows.filter(F.col("c").rlike(f"{flags}^{T.SPACE}$") & (F.length("c") == 1)).select("id").collect()}
        assert got == {i for i in range(0x10000) if chr(i).isspace()}
    import time

    text = spark.createDataFrame([("some words of a text " * 100_000,)], "s string").cache()
    text.count()

    def took(space: str) -> float:
        began = time.perf_counter()
        text.select(F.size(F.split("s", f"{space}+"))).collect()
        return time.perf_counter() - began

    plain = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
    times = [(took(T.SPACE), took(plain)) for _ in range(8)][2:]
    assert min(t[0] for t in times) < 0.85 * min(t[1] for t in times)
