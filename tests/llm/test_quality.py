import random

import numpy as np
from pyspark.sql import functions as F

from loomgraph.llm import quality

from cases import documents, empty


def corpus(spark, n=500, seed=2):
    rng = random.Random(seed)
    syllables = ["ta", "ri", "on", "the", "mel", "ka", "is", "of", "ne"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(20, 200))]
        bad = i % 5 == 0
        if bad:
            words = [w.upper() + "!!" for w in words] if i % 2 else [words[0]] * len(words)
        rows.append((i, " ".join(words), "en", f"src{i % 3}", 0))
        if i % 3:
            labels.append((i, int(not bad), 0))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_reruns(spark):
    docs, labels = corpus(spark)
    got = {r["doc_id"]: (r["keep"], r["score"]) for r in quality.score(docs, labels).collect()}
    unseen = [i for i in range(500) if i % 3 == 0]
    assert np.mean([got[i][0] == bool(i % 5) for i in unseen]) > 0.97
    assert got == {r["doc_id"]: (r["keep"], r["score"]) for r in quality.score(docs.repartition(7), labels).collect()}


class Rows:
    """A pool as plain rows: the model of what is done in passes over a table."""

    def __init__(self, one, two):
        self.x, self.size = (one, two), len(one)
        self.handed = {}  # row: (round, label by text, label by metadata)

    def steps(self, views, history):
        out = [{}, {}]
        for i in range(self.size):
            if i not in self.handed:
                for v in range(2):
                    s = int(views[v].step(self.x[v][i : i + 1])[0])
                    out[v][s] = out[v].get(s, 0) + 1
        return out

    def sums(self, history):
        views, cuts = history.rounds[-1]
        lists = {}
        for i in range(self.size):
            if i not in self.handed:
                label = [-1, -1]
                for v in range(2):
                    s = int(views[v].step(self.x[v][i : i + 1])[0])
                    label[v] = 0 if s <= cuts[v][0] else 1 if s >= cuts[v][1] else -1
                    if label[v] >= 0:
                        lists.setdefault((1 - v, label[v]), []).append(self.x[1 - v][i])
                if max(label) >= 0:
                    self.handed[i] = (len(history.rounds) - 1, *label)
        return {k: quality.products(np.array(rows)) for k, rows in lists.items()}


def test_pseudo_labels_are_those_of_brute_force(spark):
    docs, labels = corpus(spark, 600)
    table = quality.feature_table(docs).toPandas()
    found, history = quality.train(docs, labels)
    truth = {str(r["doc_id"]): r["quality"] for r in labels.collect()}
    known = table[table["doc_id"].isin(list(truth))].sort_values("doc_id", ignore_index=True)
    rest = table[~table["doc_id"].isin(list(truth))].reset_index(drop=True)
    y = np.array([truth[d] for d in known["doc_id"]], float)
    held = np.array([quality.xxhash.xxh3_64_intdigest(d) % 1000 < 1000 * quality.HELD_OUT for d in known["doc_id"]])
    rows = Rows(*quality._matrices(rest))
    model, told = quality.co_train(quality._matrices(known), y, held, rows)
    assert len(told.rounds) == len(history.rounds) > 1 and len(rows.handed) > 20
    when, *label = history.named(quality._matrices(rest))
    assert {i: (int(when[i]), int(label[0][i]), int(label[1][i])) for i in np.flatnonzero(when >= 0)} == rows.handed
    for a, b in zip(found.views, model.views):
        assert (a.weights == b.weights).all() and a.bias == b.bias


def test_cuts_take_the_surest_in_proportion():
    sure = 64 * np.log(19)
    h = {-1000: 3, -500: 4, -200: 10, 0: 50, 188: 9, 300: 7, 900: 5}
    assert 188 < sure < 189
    assert quality.cuts_of(h, 10, 0.5) == (-500, 900)
    assert quality.cuts_of(h, 22, 0.5) == (-200, 300)
    assert quality.cuts_of(h, 1000, 0.5) == (-200, 300)
    assert quality.cuts_of({0: 5}, 10, 0.5) == (-quality.LAST - 1, quality.LAST + 1)


def test_views_teach_each_other():
    """From labels of which either view sees little, the pool makes better views."""
    rng = np.random.default_rng(0)

    def rows(y):
        out = []
        for n in quality.VIEWS:
            x = rng.integers(60, 120, (len(y), n))
            x[:, :6] += (y[:, None] * rng.integers(0, 60, (len(y), 6))).astype(int)
            out.append(np.clip(x, 0, 255).astype(np.uint8))
        return tuple(out)

    y, hidden, unseen = np.array([0.0, 1.0] * 60), (rng.random(3000) < 0.5).astype(float), (rng.random(2000) < 0.5).astype(float)
    x, test, held = rows(y), rows(unseen), np.arange(120) % 4 < 2
    alone = quality.co_train(x, y, held, Rows(*(p[:0] for p in x)))[0].scores(*test)
    taught, history = quality.co_train(x, y, held, Rows(*rows(hidden)))
    found = taught.scores(*test)
    right = lambda p: ((p > 0.5) == unseen).mean()
    assert history.rounds and right(found[2]) > right(alone[2]) and right(found[2]) > 0.9


def test_awkward_cases(spark):
    docs, labels = documents(spark), spark.createDataFrame([(1, 1, "x"), (2, 1, "x"), (7, 0, "x"), (None, 1, "x"), (99, 0, "x"), (3, None, "x")], "doc_id long, quality int, score string")
    out = quality.score(docs, labels)
    assert out.columns[:2] == ["doc_id", "text"] and out.count() == docs.count()
    rows = {r["doc_id"]: r for r in out.collect()}
    assert all(rows[i]["score"] == 0 and not rows[i]["keep"] for i in (4, 5, 6))
    none = {r["doc_id"]: (r["score"], r["keep"]) for r in quality.score(docs, labels.limit(0)).collect()}
    assert none[1] == (None, True) and none[4][1] is False
    assert quality.score(empty(spark), labels).count() == 0
    assert quality.score(docs, labels.filter("quality = 1")).filter(F.col("keep")).count() > 0
