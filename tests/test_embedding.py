"""Hashed vectors against a plain model; no step holds the grams of more than one text."""

import math
import re
from collections import Counter
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from loomgraph.operators import embedding

TEXTS = [(1, "A b, a b; A"), (2, ""), (3, "é-only 7"), (4, "first part"), (4, "part two"), (None, "no id"), (5, None)]


def model():
    """id to its counted grams; rows of one id are one text, but no pair crosses them."""
    out = {}
    for i, text in TEXTS:
        t = re.findall("[a-z0-9]+", (text or "").lower())
        out.setdefault(i, Counter()).update(t + [f"{a}_{b}" for a, b in zip(t, t[1:])])
    return out


def cells(grams):
    out = {}
    for g, n in grams.items():
        h = md5(g.encode()).digest()
        out[int.from_bytes(h[:4], "big") % 256] = out.get(int.from_bytes(h[:4], "big") % 256, 0) + (1 if h[4] % 2 else -1) * (1 + math.log(n))
    return out


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(TEXTS, "id long, text string")


def steps(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_units_need_one_shuffle_of_the_texts(texts):
    """hashed_dense: it joined two computations of the same vectors."""
    df = embedding.hashed_units(texts)
    plan = steps(df)
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Aggregate" not in plan
    want = {(i, k): w / (math.sqrt(sum(x * x for x in c.values())) or 1) for i, g in model().items() if (c := cells(g)) for k, w in c.items()}
    got = [((r["id"], r["idx"]), r["v"]) for r in df.collect()]
    assert len(got) == len(want) and dict(got) == pytest.approx(want, abs=1e-6)


def test_sparse_cells_are_summed_in_their_row(texts):
    """hashed_sparse: two aggregates over all grams of a partition."""
    df = embedding.hashed_sparse(texts)
    assert "Aggregate" not in steps(df)
    want = {(i, k): w for i, g in model().items() for k, w in cells(g).items()}
    got = [((r["id"], r["idx"]), r["w"]) for r in df.collect()]
    assert len(got) == len(want) and dict(got) == pytest.approx(want)


def test_scores_need_no_aggregate(texts):
    """hashed_topk: its aggregates over grams spilled."""
    q = [0.0] * 256
    q[next(iter(cells({"first": 1})))] = 1.0
    df = embedding.hashed_scores(texts, q)
    assert "Aggregate" not in steps(df)
    at = q.index(1.0)
    want = {i: round(c.get(at, 0.0) / math.sqrt(sum(x * x for x in c.values())), 6) for i, g in model().items() if (c := cells(g))}
    assert {r["id"]: r["score"] for r in df.collect()} == pytest.approx(want, abs=1e-6)


def test_counts_are_made_text_by_text(texts):
    """tf_grams: its aggregate held all grams of a partition; an id may go over batches."""
    df = embedding.term_counts(texts)
    assert "Aggregate" not in steps(df)
    got = [((r["id"], r["gram"]), r["n"]) for r in df.collect()]
    assert len(got) == len(set(got)) and dict(got) == {(i, g): n for i, c in model().items() for g, n in c.items()}
    many = texts.sparkSession.range(0, 900, 1, 1).select((F.col("id") % 3).alias("id"), F.lit("a b a").alias("text"))
    size = texts.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    texts.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert {(r["id"], r["gram"]): r["n"] for r in embedding.term_counts(many).collect()} == {(i, g): n for i in range(3) for g, n in {"a": 600, "b": 300, "a_b": 300, "b_a": 300}.items()}
    finally:
        texts.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_texts_of_ids_of_their_own_are_not_shuffled(texts):
    """hashed_sparse: all texts were shuffled and sorted, so that a task held a share of them that the number of partitions decides."""
    own = texts.filter("id in (1, 2, 3)")
    assert "Exchange" not in steps(embedding.hashed_sparse(own))
    want = {(i, k): w for i, g in model().items() if i in (1, 2, 3) for k, w in cells(g).items()}
    assert {(r["id"], r["idx"]): r["w"] for r in embedding.hashed_sparse(own).collect()} == pytest.approx(want)


@pytest.mark.parametrize("most", [0, 1, 1000])
def test_repeated_ids_are_one_text_however_many(texts, monkeypatch, most):
    """hashed_sparse: where repeated ids, null among them, are named in the plan, and where they are too many."""
    monkeypatch.setattr(embedding, "NAMED", most)
    for more, name in (([], "long"), ([(None, "no id"), (3, None)], "long"), ([(None, "x y")], "string")):
        df = texts.union(texts.sparkSession.createDataFrame(more, "id long, text string")).withColumn("id", F.col("id").cast(name))
        whole = {}
        for i, text in TEXTS + more:
            t = re.findall("[a-z0-9]+", (text or "").lower())
            whole.setdefault(i if i is None or name == "long" else str(i), Counter()).update(t + [f"{a}_{b}" for a, b in zip(t, t[1:])])
        got = [((r["id"], r["gram"]), r["n"]) for r in embedding.term_counts(df).collect()]
        assert len(got) == len(set(got)) and dict(got) == {(i, g): n for i, c in whole.items() for g, n in c.items()}
    nulls = texts.sparkSession.createDataFrame([(None, "a"), (1, "a"), (None, "a")], "id long, text string")
    assert {(r["id"], r["n"]) for r in embedding.term_counts(nulls).collect()} == {(None, 2), (1, 1)}


def test_scores_of_ids_of_their_own_need_no_shuffle(texts):
    """hashed_topk: all texts were shuffled before they were scored."""
    df = embedding.hashed_scores(texts.filter("id in (1, 3)"), [1.0] * 256)
    assert "Exchange" not in steps(df)
    want = {i: sum(round(w / math.sqrt(sum(x * x for x in c.values())), 6) for w in c.values()) for i in (1, 3) if (c := cells(model()[i]))}
    assert {r["id"]: r["score"] for r in df.collect()} == pytest.approx(want, abs=1e-5)


def test_only_texts_of_repeated_ids_are_sorted(texts):
    """tf_grams: the sort held the partition's share of all texts."""
    plan = steps(embedding.term_counts(texts))
    assert plan.count("MapInArrow") == 2 and plan.count("Exchange") == plan.count("Sort ") == 1
    assert "Sort " not in steps(embedding.term_counts(texts.filter("id in (1, 2)")))
