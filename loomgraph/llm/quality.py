"""Quality classifier by co-training of two views.

One view sees what a text says (hashed words and pairs of words, shares of kinds of characters, repetition, word shapes), the
other what is known about it (language, source, length, layout).  Each is a linear classifier with a ridge, calibrated on
held-out labels (Platt).  In each round either view scores all documents outside the labelled sample and names those it is
surest of, a fixed share of them in the proportion of the labels, and hands them with its labels to the other view; then both
are fitted anew.  At last held-out labels weigh the two calibrated views into one probability of good quality.

The labelled sample has at most ``LABELLED`` labels, those whose ids hash lowest.  The pool is every other document:
its features, one byte each, are written once; in a round one pass counts how sure either view is (a histogram of bounded
size, from which the cut follows), and another sums the products of the features of those named.  A view follows
from such sums alone.  All are sums of integers and therefore the same in any order; they are added up in two levels, so that the
driver sees a bounded number of them.  All documents are then scored in place, without a shuffle.

Defined cases: a text that is null or has no word is of no quality: score 0; a null language or source is a
value of its own; without labels of both classes there is no classifier, scores are null and every document
with words is kept; labels without a document are ignored; contradictory labels of a document count each; of rows that
share a labelled doc_id the one with the least features is trained on; rows without a doc_id are in the pool;
repeated rows are scored each; an empty table gives an empty result; other columns are kept, but for p_text, p_meta, score and
keep, which are replaced; names that begin with two underscores are the operator's own."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import Stage, lean, ship
from loomgraph.llm.shingles import mix

#: The bound of the labelled sample, and the share of it that is held out to calibrate.
LABELLED, HELD_OUT = 12_000, 0.25
#: Rounds of exchange, the share of the pool that a view names in each, and how sure it must be.
ROUNDS, SHARE, SURE = 3, 0.05, 0.95
#: Documents with a lower probability of good quality are rejected.
THRESHOLD = 0.5
WINDOW = 100
#: Of a view: the ridge relative to a feature's variance, and the largest weight (weights are whole numbers).
RIDGE, LARGEST = 0.02, 1 << 26
#: Steps of a logit that the histogram tells apart, and its largest step.
STEPS, LAST = 64, 1280
#: Groups of tasks whose sums are added up before the driver sees them.
SUMS = 32


def _kinds() -> np.ndarray:
    """Of each byte its kind."""
    kind = np.full(256, 11)
    kind[ord("a") : ord("z") + 1], kind[ord("A") : ord("Z") + 1], kind[ord("0") : ord("9") + 1] = 0, 1, 2
    kind[128:] = 3
    for k, chars in ((4, " "), (5, "\n"), (6, ".,;:'"), (7, "!?"), (8, "#$%&*@^~+=<>"), (9, "|/\\_-"), (10, "()[]{}\"")):
        for c in chars:
            kind[ord(c)] = k
    return kind


_KIND = _kinds()
SHARES, HASHED = 20, 108
CONTENT = SHARES + HASHED
LANGS, SOURCES, LAYOUT = 8, 32, 6
META = LAYOUT + LANGS + SOURCES
VIEWS = (CONTENT, META)


def content_features(data: bytes, words: list[bytes]) -> np.ndarray:
    """Features of the text view, as bytes; shares, so that they do not grow with a text."""
    n, w = len(data), len(words)
    kinds = np.bincount(_KIND, weights=np.bincount(np.frombuffer(data, np.uint8), minlength=256), minlength=12) / n
    lower = [x.lower() for x in words]
    different = sum(len(set(lower[i : i + WINDOW])) for i in range(0, w, WINDOW)) / w
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, lower), np.uint64, w)
    pairs = mix(h[:-1] * np.uint64(3) + h[1:])
    again = sum(map(eq, lower, lower[1:])) / max(1, w - 1)
    pair_share = sum(len(np.unique(pairs[i : i + WINDOW])) for i in range(0, len(pairs), WINDOW)) / max(1, len(pairs))
    letters = max(kinds[0] + kinds[1], 1e-6)
    length = (n - w + 1) / w
    ends = sum(x[-1] in b".,;:" for x in words) / w
    capital = sum(65 <= x[0] <= 90 for x in words) / w
    shares = [*kinds, different, again, pair_share, min(kinds[1] / letters, 1.0), min(length, 30.0) / 30, ends, capital, different * different]
    terms = np.log1p(np.bincount((np.concatenate([h, pairs]) % np.uint64(HASHED)).astype(np.int64), minlength=HASHED))
    return np.rint(255 * np.concatenate([shares, terms / math.sqrt((terms * terms).sum())])).astype(np.uint8)


def _slot(value: str | None, n: int) -> int:
    return xxhash.xxh3_64_intdigest("\x00" if value is None else value) % n


def meta_features(data: bytes, words: int, lang: str | None, source: str | None) -> np.ndarray:
    """Features of the view of what is known about a document, as bytes."""
    lines = data.split(b"\n")
    lengths = [len(x) for x in lines]
    logs = [math.log1p(len(data)), math.log1p(words), math.log1p(len(lines)), math.log1p(len(data) / len(lines)), math.log1p(max(lengths))]
    out = np.zeros(META, np.uint8)
    out[:LAYOUT] = [*(min(255, round(12 * x)) for x in logs), round(255 * sum(x < 40 for x in lengths) / len(lines))]
    out[LAYOUT + _slot(lang, LANGS)] = 255
    out[LAYOUT + LANGS + _slot(source, SOURCES)] = 255
    return out


def features(texts, langs, sources) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both views, and whether a row has words at all."""
    one, two, some = np.zeros((len(texts), CONTENT), np.uint8), np.zeros((len(texts), META), np.uint8), np.zeros(len(texts), bool)
    for i, (text, lang, source) in enumerate(zip(texts, langs, sources, strict=True)):
        data = text.encode("utf-8", "surrogatepass") if text else b""
        words = data.split()
        if words:
            some[i], one[i], two[i] = True, content_features(data, words), meta_features(data, len(words), lang, source)
    return one, two, some


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Logistic:
    """Logistic regression of a few features with a ridge, on standardised features, by Newton steps."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Logistic:
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale[scale < 1e-9] = 1.0
        z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
        w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(25):
            p = _sigmoid(z @ w)
            step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
            w += step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -10, 10) @ self.weights[:-1] + self.weights[-1]


def products(x: np.ndarray) -> np.ndarray:
    """Sums of the products of the features and 1; of whole numbers below 2 ** 53, and so exact."""
    z = np.column_stack([x, np.ones(len(x), np.uint8)]).astype(float)
    return z.T @ z


@dataclass
class View:
    """A linear classifier with whole weights, whose sums are exact in any order, and its calibration."""

    weights: np.ndarray
    bias: float
    unit: float
    platt: Logistic | None = None

    @classmethod
    def fit(cls, bad: np.ndarray, good: np.ndarray) -> View:
        """Least squares, both classes of equal weight, from the products of each."""
        m = bad / bad[-1, -1] / 2 + good / good[-1, -1] / 2
        mean = m[:-1, -1]
        cov = m[:-1, :-1] - np.outer(mean, mean)
        w = np.linalg.solve(cov + np.diag(RIDGE * (np.diag(cov) + 1.0)), (good[:-1, -1] / good[-1, -1] - bad[:-1, -1] / bad[-1, -1]) / 2)
        unit = max(np.abs(w).max(), 1e-12) / LARGEST
        return cls(np.rint(w / unit), float(np.rint(-(w @ mean) / unit)), float(unit))

    def value(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(float) @ self.weights + self.bias) * self.unit

    def logit(self, x: np.ndarray) -> np.ndarray:
        """Calibrated."""
        return self.platt.logit(self.value(x)[:, None])

    def step(self, x: np.ndarray) -> np.ndarray:
        """The step of the logit."""
        return np.clip(np.floor(STEPS * self.logit(x)), -LAST, LAST).astype(np.int64)


@dataclass
class Classifier:
    views: tuple[View, View]
    both: Logistic

    def scores(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities by the text view, by the other, and by both."""
        z = [v.logit(x) for v, x in zip(self.views, (one, two), strict=True)]
        return _sigmoid(z[0]), _sigmoid(z[1]), _sigmoid(self.both.logit(np.column_stack(z)))


@dataclass
class History:
    """Of each round the views, and of each view the steps up to which it names a document bad, and from which on good."""

    rounds: list[tuple[tuple[View, View], list[tuple[int, int]]]] = field(default_factory=list)

    def named(self, x: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each row the round that first names it (-1: none), and the label by either view there (-1: none)."""
        n = len(x[0])
        when, label = np.full(n, -1), (np.full(n, -1), np.full(n, -1))
        for r, (views, cuts) in enumerate(self.rounds):
            left = np.flatnonzero(when < 0)
            for v in range(2):
                step = views[v].step(x[v][left])
                label[v][left] = np.where(step >= cuts[v][1], 1, np.where(step <= cuts[v][0], 0, -1))
            when[left[(label[0][left] >= 0) | (label[1][left] >= 0)]] = r
        return when, label[0], label[1]


def cuts_of(histogram: dict[int, int], wanted: float, good: float) -> tuple[int, int]:
    """The steps up to which, and from which on, documents are named: the surest ones, ``wanted`` in all in the proportion of the
    labels, whole steps, none less sure than ``SURE``."""
    sure = math.ceil(STEPS * math.log(SURE / (1 - SURE)))
    out = []
    for steps, most in ((sorted(s for s in histogram if s < -sure), wanted * (1 - good)), (sorted((s for s in histogram if s >= sure), reverse=True), wanted * good)):
        n, cut = 0, None
        for s in steps:
            if n >= most:
                break
            n, cut = n + histogram[s], s
        out.append(cut)
    return (-LAST - 1 if out[0] is None else out[0]), (LAST + 1 if out[1] is None else out[1])


def fitted(x: tuple[np.ndarray, np.ndarray], y: np.ndarray, held: np.ndarray, more: dict[tuple[int, int], np.ndarray]) -> tuple[View, View]:
    """Both views, from labelled features and the products of what they were handed, by (view, label), and calibrated.

    However many were handed, they weigh as much as the labels at most."""
    out = []
    for v in range(2):
        sums = []
        for c in range(2):
            own = products(x[v][~held & (y == c)])
            if (v, c) in more and more[v, c][-1, -1]:
                own = own + more[v, c] * min(1.0, own[-1, -1] / more[v, c][-1, -1])
            sums.append(own)
        view = View.fit(*sums)
        view.platt = Logistic.fit(view.value(x[v][held])[:, None], y[held])
        out.append(view)
    return out[0], out[1]


def co_train(x: tuple[np.ndarray, np.ndarray], y: np.ndarray, held: np.ndarray, pool) -> tuple[Classifier, History]:
    """held: which labels calibrate.  pool has ``size``, ``steps(views, history)``, which gives the histograms of either view over the
    documents not named yet, and ``sums(history)``, which gives the products of those named last, by (view they are handed to, label)."""
    more: dict[tuple[int, int], np.ndarray] = {}
    views, history = fitted(x, y, held, more), History()
    good = float(y[~held].mean())
    for _ in range(ROUNDS if pool.size else 0):
        cuts = [cuts_of(h, SHARE * pool.size, good) for h in pool.steps(views, history)]
        if all(low < -LAST and high > LAST for low, high in cuts):
            break
        history.rounds.append((views, cuts))
        for key, p in pool.sums(history).items():
            more[key] = more.get(key, 0) + p
        views = fitted(x, y, held, more)
    z = np.column_stack([v.logit(p[held]) for v, p in zip(views, x, strict=True)])
    return Classifier(views, Logistic.fit(z, y[held])), history


def step_counts(x: tuple[np.ndarray, np.ndarray], views: tuple[View, View], history: History) -> list[np.ndarray]:
    """Of either view, how many of the rows not named yet have each step, from -LAST on."""
    left = history.named(x)[0] < 0
    return [np.bincount(views[v].step(x[v][left]) + LAST, minlength=2 * LAST + 1) for v in range(2)]


def named_sums(x: tuple[np.ndarray, np.ndarray], history: History) -> Iterator[tuple[int, int, np.ndarray]]:
    """View, label and products of the rows that the other view named in the last round."""
    when, *label = history.named(x)
    now = when == len(history.rounds) - 1
    for v in range(2):
        for c in range(2):
            if (rows := now & (label[v] == c)).any():
                yield 1 - v, c, products(x[1 - v][rows])


def _matrices(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(b"".join(pdf[name]), np.uint8).reshape(len(pdf), n) for name, n in zip(("one", "two"), VIEWS, strict=True))


class Pool:
    """The documents outside the labelled sample, as a written table of features."""

    def __init__(self, table: DataFrame):
        self.table, self.size = table, table.count()

    def steps(self, views: tuple[View, View], history: History) -> list[dict[int, int]]:
        @lean
        def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = [np.zeros(2 * LAST + 1, np.int64) for _ in range(2)]
            for pdf in batches:
                for t, n in zip(total, step_counts(_matrices(pdf), views, history), strict=True):
                    t += n
            for v, t in enumerate(total):
                there = np.flatnonzero(t)
                yield pd.DataFrame({"view": v, "step": there - LAST, "n": t[there]})

        rows = self.table.mapInPandas(go, "view int, step int, n long").groupBy("view", "step").agg(F.sum("n").alias("n")).collect()
        return [{r["step"]: r["n"] for r in rows if r["view"] == v} for v in range(2)]

    def sums(self, history: History) -> dict[tuple[int, int], np.ndarray]:
        @lean
        def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total: dict[tuple[int, int], np.ndarray] = {}
            for pdf in batches:
                for v, c, p in named_sums(_matrices(pdf), history):
                    total[v, c] = total.get((v, c), 0) + p
            yield pd.DataFrame([(v, c, p.tobytes()) for (v, c), p in total.items()], columns=["view", "label", "sums"])

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            whole = sum(np.frombuffer(b) for b in pdf["sums"])
            return pd.DataFrame({"view": pdf["view"][:1], "label": pdf["label"][:1], "sums": [whole.tobytes()]})

        kind = "view int, label int, sums binary"
        rows = self.table.mapInPandas(go, kind).withColumn("part", F.spark_partition_id() % SUMS)
        out: dict[tuple[int, int], np.ndarray] = {}
        for r in rows.groupBy("view", "label", "part").applyInPandas(add, kind).collect():
            n = VIEWS[r["view"]] + 1
            out[r["view"], r["label"]] = out.get((r["view"], r["label"]), 0) + np.frombuffer(r["sums"]).reshape(n, n)
        return out


def feature_table(docs: DataFrame) -> DataFrame:
    """doc_id, one, two of every row with words."""

    @lean
    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            one, two, some = features(pdf["text"], pdf["lang"], pdf["source"])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "one": [x.tobytes() for x in one], "two": [x.tobytes() for x in two]})[some]

    # Ids travel as strings: pandas would turn integers with nulls among them to floats.
    rows = docs.select(F.col("doc_id").cast("string"), "text", "lang", "source").filter("text is not null")
    return rows.mapInPandas(go, "doc_id string, one binary, two binary")


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> tuple[Classifier, History] | None:
    stage = Stage(docs.sparkSession, "quality")
    known = labels.filter("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("string").alias("doc_id"), "quality").distinct()
    some = stage.write(known.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id", "quality").limit(labelled), "labels")  # bounded, so broadcast
    rows = stage.write(feature_table(docs), "features")
    given = rows.join(F.broadcast(some), "doc_id").groupBy("doc_id", "quality").agg(F.min(F.struct("one", "two")).alias("x"))
    a = given.select("doc_id", "quality", "x.*").toPandas().sort_values(["doc_id", "quality"], kind="stable", ignore_index=True)
    y = a["quality"].to_numpy(float)
    if len(set(y)) < 2:
        return None
    held = np.array([xxhash.xxh3_64_intdigest(d) % 1000 < 1000 * HELD_OUT for d in a["doc_id"]], bool)
    pool = Pool(rows.join(F.broadcast(some.select("doc_id").distinct()), "doc_id", "left_anti"))
    if any(len(set(y[m])) < 2 for m in (held, ~held)):
        return _small(_matrices(a), y), History()
    return co_train(_matrices(a), y, held, pool)


def _small(x: tuple[np.ndarray, np.ndarray], y: np.ndarray) -> Classifier:
    """From too few labels to hold any out: fitted and calibrated on the same."""
    views = []
    for v in x:
        view = View.fit(products(v[y == 0]), products(v[y == 1]))
        view.platt = Logistic.fit(view.value(v)[:, None], y)
        views.append(view)
    return Classifier((views[0], views[1]), Logistic.fit(np.column_stack([v.logit(p) for v, p in zip(views, x, strict=True)]), y))


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with p_text, p_meta, score and keep."""
    spark = docs.sparkSession
    ship(spark)
    found = train(docs, labels)
    model = spark.sparkContext.broadcast(found and found[0])

    @F.pandas_udf("p_text double, p_meta double, score double, keep boolean")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        m = model.value
        for batch in batches:
            one, two, some = features(*batch)
            out = pd.DataFrame(dict.fromkeys(("p_text", "p_meta", "score"), np.where(some, np.nan, 0.0)))
            if m is None:
                out = out.astype(object).where(out.notna(), None)
                out["keep"] = some
            else:
                for name, p in zip(("p_text", "p_meta", "score"), m.scores(one, two), strict=True):
                    out[name] = np.where(some, np.round(p, 9), 0.0)
                out["keep"] = some & (out["score"] >= threshold)
            yield out

    judged = judge(F.col("text"), F.col("lang"), F.col("source"))
    rest = [c for c in docs.columns if c not in ("p_text", "p_meta", "score", "keep")]
    return docs.withColumn("__judged", judged).select(*rest, "__judged.*")
