import random

from loomgraph.llm import jaccard_join

from cases import documents, empty


def model(rows, n, percent):
    """doc_id -> (size, component), comparing all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    parent = list(range(len(rows)))
    find = lambda x: x if parent[x] == x else find(parent[x])
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}


def near_copies(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choices(vocabulary, k=rng.choice([2, 3, 9, 40, 120])) for _ in range(25)]
    rows = []
    for i in range(n):
        words = list(rng.choice(base[: 25 if i % 2 else 3]))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            k = rng.randrange(len(words) + 1)
            words[k : k + rng.choice([0, 1])] = rng.choices(vocabulary, k=rng.choice([0, 1]))
        rows.append((i * 7 % 1009, " ".join(words)))
    return rows


def test_matches_brute_force(spark):
    for seed, n, percent in ((1, 3, 90), (2, 5, 80)):
        rows = near_copies(seed, 500)
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(df, n, percent).collect()}
        assert got == model(rows, n, percent)


def test_rows_of_one_id_with_different_texts(spark):
    """All links of both texts count, in any order of the rows."""
    a, b = ([f"{x}{i}" for i in range(101)] for x in "ab")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join([*a, "more"])), (3, " ".join([*b, "more"])), (4, "apart from them"), (None, " ".join([*b, "none"])), (None, "alone here")]
    for some in (rows, rows[::-1], rows + rows):
        df = spark.createDataFrame(some, "doc_id long, text string")
        got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard_join.jaccard_classes(df).collect()}
        assert got == {(1, 99): 1, (2, 100): 1, (3, 100): 1, (4, 1): 4, (None, 100): 1, (None, 1): None}


def test_awkward_cases(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None]
    out = jaccard_join.jaccard_classes(docs).collect()
    assert len(out) == docs.count()
    want = model(rows, 3, 90)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out if r["doc_id"] is not None} == want
    assert want[3][1] == 1 and want[8][1] == 7
    assert jaccard_join.jaccard_classes(empty(spark)).count() == 0


def test_rows_that_repeat_or_have_no_doc_id_link_by_their_sets(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(100)) for c in "ab")
    rows = [(1, a), (1, a), (2, a + " x"), (None, b), (None, b), (None, b + " y"), (7, b + " z"), (9, "q r s t"), (10, None), (10, "")]
    out = jaccard_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [(1, 98, 1), (1, 98, 1), (2, 99, 1), (None, 98, 7), (None, 98, 7), (None, 99, 7), (7, 99, 7), (9, 2, 9), (10, 0, 10), (10, 0, 10)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_first_tokens_meet_wherever_sets_are_similar():
    import numpy as np

    rng = np.random.default_rng(3)
    common = np.unique(rng.integers(0, 2**63, 50).astype(np.uint64))
    times = rng.integers(32, 99, len(common))
    for _ in range(300):
        size = int(rng.integers(1, 200))
        a = np.unique(np.concatenate([rng.integers(0, 2**63, size).astype(np.uint64), rng.choice(common, min(len(common), size))]))
        b = np.unique(np.concatenate([rng.permutation(a)[: len(a) - int(rng.integers(0, 1 + len(a) // 12))], rng.integers(0, 2**63, int(rng.integers(0, 1 + len(a) // 15))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 90 * (len(a) + len(b) - both):
            continue
        x, y = (jaccard_join.first_tokens(s, common, times, 90) for s in (a, b))
        least = min(jaccard_join.depth(len(a)), jaccard_join.depth(len(b)))
        early = lambda p, n, o: (p + 1 - least) * 190 - 100 * n + 90 * o <= 0
        at = {t: i for i, t in enumerate(y.tolist())}
        met = sum(early(i, len(a), len(b)) and early(at[t], len(b), len(a)) for i, t in enumerate(x.tolist()) if t in at)
        assert met >= least
