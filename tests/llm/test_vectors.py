import math

import numpy as np
import pytest

from loomgraph.llm import ann, bit_sliced, vectors
from loomgraph.llm import vectors as V

import cases


def usable(df, zero):
    return [(r["vec_id"], r["embedding"]) for r in df.collect() if r["vec_id"] is not None and r["embedding"] and all(x is not None and math.isfinite(x) for x in r["embedding"]) and (zero or any(r["embedding"]))]


def brute(rows, every, k, f):
    out = {}
    for q, v in {q: v for q, v in sorted(rows, key=str) if q % every == 0}.items():
        scored = sorted((-f(v, x), i) for i, x in rows if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def results(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def quantised(a, b):
    return sum(math.floor(1024 * x) * math.floor(1024 * y) for x, y in zip(a, b))


def test_bit_sliced_is_exact(spark):
    df = cases.vectors(spark)
    assert results(bit_sliced.top_k(df, 20, 10)) == brute(usable(df, True), 20, 10, quantised)


def test_small_blocks_of_rows_and_queries(spark):
    df = cases.vectors(spark, 150)
    got = results(V.search(df, 10, 5, True, "test", bit_sliced.Index, block_rows=32, block_queries=4))
    assert got == brute(usable(df, True), 10, 5, quantised)


def test_fewer_candidates_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (100, [0.5]), (3, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    assert results(bit_sliced.top_k(df)) == {0: [(100, 1024 * 512), (3, -(1024**2))], 100: [(0, 1024 * 512), (3, -1024 * 512)]}
    assert bit_sliced.top_k(df.limit(0)).count() == 0 and ann.nearest(df.limit(0)).count() == 0
    assert [len(v) for v in results(ann.nearest(df)).values()] == [2, 2]


def test_adders_select_and_compare():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 8, (130, 3))
    words = -(-130 // 64)
    total = bit_sliced.Slices(10, words)
    for d, at in ((0, 0), (1, 2), (2, 1)):
        total.add(bit_sliced._pack((x[:, d, None] >> np.arange(3)) & 1 > 0), at)
    there = bit_sliced._pack(np.ones((130, 1), bool))[0]
    want = x[:, 0] + 4 * x[:, 1] + 2 * x[:, 2]
    for k in (1, 7, 130):
        assert total.kth(k, there) == np.sort(want)[::-1][k - 1]
    for v in (0, 9, 20, 5000):
        assert (np.unpackbits(total.at_least(v, there).view(np.uint8), bitorder="little")[:130] == (want >= v)).all()


def test_ann_recall_and_exact_scores(spark):
    df = cases.vectors(spark, 3000, 12)
    rows = usable(df, False)
    got = results(ann.nearest(df, 20, 20))
    want = brute(rows, 20, 20, lambda a, b: float(np.dot(a, b)))
    assert got.keys() == want.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    by = dict(rows)
    for q, found in list(got.items())[:20]:
        assert [s for _, s in found] == pytest.approx([float(np.dot(by[q], by[i])) for i, _ in found], abs=1e-12)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_ann_ids_of_many_equal_vectors_and_scores(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 12))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    ids = rng.permutation(3000)
    x[:900] = x[0]
    x[900:1000] = x[900]
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows, 20, 20, lambda a, b: float((np.array(a) * np.array(b)).sum()))
    copied = {q for q in want if q in set(ids[:1000].tolist())}
    for size in (32_768, 700):
        got = results(V.search(df, 20, 20, False, "test", ann.Index, block_rows=size))
        assert copied and all(got[q] == want[q] for q in copied)
        assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    # Different vectors with one score: all that were read compete.
    x = np.concatenate([[[1.0, 0, 0, 0]], np.column_stack([np.full(200, 0.5), rng.standard_normal((200, 3))])])
    ids = np.concatenate([[0], 1 + rng.permutation(200)])
    best = V.Best(1, 20, "float64")
    ann.Index(ids, x, sure=1 - 1e-12).search(ids[:1], x[:1], best)
    assert best.ids[0].tolist() == list(range(1, 21)) and set(best.scores[0].tolist()) == {0.5}


@pytest.mark.parametrize("order", ["up", "down", "mixed"])
def test_ann_equal_vectors_in_any_order(spark, order):
    rng = np.random.default_rng(4)
    ids = list(range(50)) if order == "up" else list(range(49, -1, -1)) if order == "down" else rng.permutation(50).tolist()
    v, other = [0.6, 0.8, 0.0, 0.0], rng.standard_normal((300, 4))
    rows = [(i, v) for i in ids] + [(1000 + 7 * i, (0.1 * x).tolist()) for i, x in enumerate(other)]
    got = results(ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    assert [i for i, _ in got[0]] == list(range(1, 21)) and [i for i, _ in got[20]] == list(range(20))


def test_ann_verifies_a_third_of_the_rows_at_most():
    """Vectors as the tables have them: unit length, near-random around a few centres."""
    rng = np.random.default_rng(5)
    n, dim = 30_000, 64
    x = rng.standard_normal((n, dim)) + 0.45 * rng.standard_normal((10, dim))[rng.integers(0, 10, n)]
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    ids, asked = np.arange(n), np.arange(0, n, 300)
    best = V.Best(len(asked), 20, "float64")
    blocks = [ann.Index(ids[a : a + V.BLOCK_ROWS], x[a : a + V.BLOCK_ROWS]) for a in range(0, n, V.BLOCK_ROWS)]
    for b in blocks:
        b.search(asked, x[asked], best)
    recall = []
    for i, q in enumerate(asked):
        s = x @ x[q]
        s[q] = -9
        recall.append(len(set(best.ids[i].tolist()) & set(np.argsort(-s)[:20].tolist())) / 20)
    assert np.mean(recall) >= 0.9
    assert sum(b.verified for b in blocks) / len(asked) / n <= 1 / 3


@pytest.mark.parametrize("size", [1e17, 1e25, 1e30, 1e200])
def test_large_finite_values(spark, size):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((400, 8))
    rows = [(i, (v * size if i % 3 else v).tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = results(ann.nearest(df))
    assert all(len(v) == 20 for v in got.values()) and len(got) == 20
    if size < 1e100:
        want = brute(rows, 20, 20, lambda a, b: float((np.array(a) * np.array(b)).sum()))
        assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    long = lambda s: min(2**63 - 1, max(-(2**63), s))
    exact = lambda a, b: long(sum(math.floor(1024 * x) * math.floor(1024 * y) if size < 1e100 else int(x * 1024) * int(y * 1024) for x, y in zip(a, b)))
    got = results(bit_sliced.top_k(df))
    if size < 1e100:
        assert got == brute(rows, 100, 10, exact)
    assert all(len(v) == 10 for v in got.values()) and len(got) == 4


def test_outliers_in_length_do_not_hide_the_others():
    rng = np.random.default_rng(7)
    x = rng.standard_normal((5000, 16))
    x[::500] *= 1e6
    ids = np.arange(5000)
    best = V.Best(40, 20, "float64")
    ann.Index(ids, x).search(ids[1:41], x[1:41], best)
    for i in range(40):
        s = x @ x[i + 1]
        s[i + 1] = -np.inf
        assert len(set(best.ids[i].tolist()) & set(np.argsort(-s)[:20].tolist())) >= 13


def test_chi_square():
    assert ann.chi_square_cdf(ann.chi_square_quantile(0.9, 8), 8) == pytest.approx(0.9)
    assert ann.chi_square_quantile(0.9, 8) == pytest.approx(13.3616, abs=1e-3)
    assert vectors.BLOCK_ROWS > 0
