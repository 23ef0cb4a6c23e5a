import math
import random
from collections import defaultdict

import pytest

from loomgraph.llm import mixing

from cases import documents, empty


def test_targets_fill_up_to_the_cap():
    for seed in range(100):
        rng = random.Random(seed)
        sizes = [rng.choice([0, 3, 50, 1000, 10_000]) for _ in range(rng.randint(1, 9))]
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        got = mixing.targets(sizes, weights, 1.5 * sum(sizes), 2.0)
        assert math.isclose(sum(got), 1.5 * sum(sizes), abs_tol=1e-6)
        assert all(t <= 2 * s + 1e-9 for t, s in zip(got, sizes))
        free = [t / w for t, w, s in zip(got, weights, sizes) if t < 2 * s]
        assert not free or max(free) - min(free) < 1e-6 * max(free)
        assert all(t / w <= max(free, default=math.inf) + 1e-6 for t, w, s in zip(got, weights, sizes))


def test_sainte_lague_gives_highest_quotients():
    for seed in range(200):
        rng = random.Random(seed)
        w = [rng.choice([0, 1, 2.5, 7, 7, 100, 1e6 * rng.random()]) for _ in range(rng.randint(1, 8))]
        most = [rng.choice([0, 1, 5, 1000]) for _ in w]
        seats = rng.randint(0, 40)
        want = [0] * len(w)
        for _ in range(seats):
            best = max((i for i in range(len(w)) if w[i] > 0 and want[i] < most[i]), key=lambda i: (w[i] / (2 * want[i] + 1), -i), default=None)
            if best is None:
                break
            want[best] += 1
        assert mixing.sainte_lague(w, seats, most) == want, (w, seats, most)


def table(spark, n=400):
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choice(["a", "a", "b", "c", "d", None]), 0) for i in range(n)]
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, n_chars long, epochs string")


def test_mix_is_near_its_targets_and_repeats(spark):
    docs = table(spark)
    rows = mixing.mix(docs).collect()
    assert {r["doc_id"]: r["taken"] for r in rows} == {r["doc_id"]: r["taken"] for r in mixing.mix(docs.repartition(3)).collect()}
    by = defaultdict(lambda: [0, 0, None, None])
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        s = by[source[r["doc_id"]]]
        s[0] += r["taken"]
        s[1] += r["size"]
        s[2], s[3] = r["target"], r["source_size"]
    for taken, size, target, told in by.values():
        assert told == size and abs(taken - target) <= 2 * mixing.BLOCK
    assert sum(s[2] for s in by.values()) == pytest.approx(1.5 * sum(s[1] for s in by.values()))


def test_applied_texts_hold_what_is_taken(spark):
    docs = table(spark)
    mixed = mixing.mix(docs)
    taken = {r["doc_id"]: r["taken"] for r in mixed.collect() if r["taken"]}
    out = mixing.apply_mix(docs, mixed)
    assert out.columns == docs.columns
    assert {r["doc_id"]: len(r["text"].split()) for r in out.collect()} == taken


def test_few_documents_are_cut_and_large_ids_are_kept(spark):
    big = 9007199254740993
    rows = [(big + i, " ".join(f"d{i}w{j}" for j in range(100)), "a" if i % 2 else "b", None if i % 3 else big) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, other long")
    out = mixing.apply_mix(docs, mixing.mix(docs)).collect()
    assert {(r["doc_id"], r["other"]) for r in out} <= {(r[0], r[3]) for r in rows}
    assert sum(len(r["text"].split()) % 100 > 0 for r in out) <= 4  # two a shard


def test_many_rows_without_an_id_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SAME", 8)
    monkeypatch.setattr(mixing, "SHARD_DOCS", 16)
    rows = [(None, "w " * (i % 5), "a") for i in range(300)] + [(7, "one two", "a")] * 200 + [(i, "x y z", "b") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, block=1)
    assert got.count() == 600
    key = lambda df: sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in df.collect())
    assert key(got) == key(mixing.mix(docs.repartition(5), block=1))
    for size in (200 * 2 + 600, 300):
        some = [r for r in got.collect() if r["source_size"] == size]
        assert some and abs(sum(r["taken"] for r in some) - some[0]["target"]) <= 2 * mixing.BLOCK
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in some)


def test_awkward_cases(spark):
    rows = mixing.mix(documents(spark)).collect()
    assert len(rows) == documents(spark).count()
    size = {r["doc_id"]: r["size"] for r in rows}
    assert size[4] == size[5] == size[6] == 0 and size[9] == 30_000
    assert mixing.mix(empty(spark)).count() == 0
