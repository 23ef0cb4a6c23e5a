"""Sections and windows against small models."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomgraph.operators import chunking


def sections_model(md):
    path, body, out = [], [], []
    for line in md.splitlines():
        m = re.match(r"(#{1,6})\s+(.*)$", line)
        if not m:
            body.append(line)
            continue
        if body:
            out.append(([t for _, t in path], "\n".join(body)))
            body = []
        level = len(m[1])
        path = [p for p in path if p[0] < level] + [(level, m[2].strip())]
    if body:
        out.append(([t for _, t in path], "\n".join(body)))
    return out


LINES = st.lists(st.sampled_from(["# a", "## b", "### c", "## d", "####### no", "#x", "text", "", "more text", "# "]), max_size=12)


def test_sections_match_a_model(spark):
    cases = []

    @settings(max_examples=80, deadline=None)
    @given(LINES, st.sampled_from(["\n", "\r\n", "\x85"]), st.booleans())
    def collect(lines, sep, ended):
        cases.append(sep.join(lines) + sep * ended)

    collect()
    cases += ["", "\n", "# only", "a b"]
    df = spark.createDataFrame(list(enumerate(cases)), "n int, text string")
    got = {}
    for r in chunking.sections(df).orderBy("n", "section").collect():
        got.setdefault(r["n"], []).append((r["heading_path"], r["body"]))
    assert got == {i: s for i, c in enumerate(cases) if (s := sections_model(c))}


def test_windows_cover_all_words(spark):
    df = spark.range(1, 1500).withColumn("w", F.transform(F.sequence(F.lit(1), F.col("id")), lambda x: x.cast("string")))
    for r in df.select("id", chunking.windows(F.col("w"), 246, 36).alias("s")).collect():
        starts, n = r["s"], r["id"]
        assert starts[0] == 0 and starts[-1] + 246 >= n
        assert all(b - a == 210 for a, b in zip(starts, starts[1:]))
        assert len(starts) == 1 or starts[-2] + 246 < n


def test_numbering_skips_short_chunks(spark):
    docs = spark.createDataFrame([("d", "# a\nshort\n# b\n" + "w " * 20)], "slug string, text string")
    rows = chunking.chunk(docs, "slug").collect()
    assert [(r["id"], r["heading_path"], r["n_words"], r["token_est"]) for r in rows] == [("d::0000", ["b"], 20, 26)]


def test_texts_are_read_once(spark, tmp_path):
    """One scan and no shuffle, whether texts have headings or not; columns to keep come along, and rows of one slug stay apart."""
    spark.createDataFrame([("d", "a", "w " * 20), ("d", "b", "# h\n" + "v " * 20), ("e", None, "# x")], "slug string, source string, text string").coalesce(1).write.parquet(str(tmp_path / "t"))
    df = chunking.chunk(spark.read.parquet(str(tmp_path / "t")), "slug", keep=["source"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert sorted((r["id"], r["source"], r["heading_path"], r["text"][0]) for r in df.collect()) == [("d::0000", "a", [], "w"), ("d::0000", "b", ["h"], "v")]
