"""Embeddings: the deterministic hashed provider, text by text, and pluggable model providers."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loomgraph.functions import vectors as V

try:
    from _md5 import md5  # CPython's own, which is faster on short strings
except ImportError:
    from hashlib import md5

DIM = 256
#: Values that a task holds back before it hands them on.
HELD = 1 << 16
#: Repeated ids up to which they are named in the plan.
NAMED = 1_000


def _counted(lowered: str | None, into: Counter[str]) -> None:
    """Counts the tokens of a text and its pairs of neighbours."""
    toks = re.findall("[a-z0-9]+", lowered or "")
    into.update(toks)
    into.update(map("_".join, pairwise(toks)))


def _cells(grams: Counter[str], dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The indices that a gram falls on, and the sums there: the first four bytes of a gram's MD5 are its place, the low bit of the fifth its sign."""
    hashes = np.frombuffer(b"".join([md5(g.encode()).digest() for g in grams]), np.uint8).reshape(-1, 16)
    at = np.ascontiguousarray(hashes[:, :4]).view(">u4").ravel().astype(np.int64) % dim
    w = np.where(hashes[:, 4] & 1, 1.0, -1.0) * (1.0 + np.log(np.fromiter(grams.values(), np.float64, len(grams))))
    held = np.bincount(at, minlength=dim) > 0
    return np.flatnonzero(held), np.bincount(at, w, dim)[held]


def _unit(w: np.ndarray) -> np.ndarray:
    norm = np.sqrt(w @ w)
    return w / norm if norm > 0 else w


def _repeated(texts: DataFrame) -> list | None:
    """The ids of several rows; None where they are too many to be named, or of a kind that is not.  Texts are not read for it."""
    if not isinstance(texts.schema["id"].dataType, (T.StringType, T.IntegralType)):
        return None
    rows = texts.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id").limit(NAMED + 1).collect()
    return [r["id"] for r in rows] if len(rows) <= NAMED else None


def _by_text(texts: DataFrame, kind: str, row: Callable[[Counter[str]], tuple], merged: bool, size: int = 1) -> DataFrame:
    """id and the columns of ``kind``, made from the counted grams of one text at a time, so that a task holds one text's grams, not its
    partition's.  ``merged`` takes rows of one id as one text; they are brought together by sorting the texts of repeated ids, which are
    the only ones that are shuffled (all texts, where such ids are many).  ``size``: values in a row, about."""
    schema = T.StructType([T.StructField("id", texts.schema["id"].dataType), *T._parse_datatype_string(kind).fields])
    x = texts.select("id", F.lower("text").alias("text"))
    together = lambda df: df.repartition("id").sortWithinPartitions("id")
    most = max(1, HELD // size)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        ids, rows, open_, last = [], [], None, None

        def out() -> pa.RecordBatch:
            columns = zip(*rows) if rows else ((),) * (len(arrow) - 1)
            batch = pa.RecordBatch.from_arrays([pa.array(ids, arrow.field(0).type), *(pa.array(list(c), f.type) for c, f in zip(columns, list(arrow)[1:]))], schema=arrow)
            ids.clear()
            rows.clear()
            return batch

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if open_ is not None and not (merged and i == last):
                    ids.append(last)
                    rows.append(row(open_))
                    open_ = None
                    if len(ids) >= most:
                        yield out()
                if open_ is None:
                    open_, last = Counter(), i
                _counted(text.as_py(), open_)
        if open_ is not None:
            ids.append(last)
            rows.append(row(open_))
        if ids:
            yield out()

    if not merged:
        return x.mapInArrow(go, schema)
    ids = _repeated(texts)
    if not ids:
        return (x if ids == [] else together(x)).mapInArrow(go, schema)
    again = F.when(F.col("id").isNull(), F.lit(None in ids)).otherwise(F.col("id").isin([i for i in ids if i is not None]))
    return x.filter(~again).mapInArrow(go, schema).union(together(x.filter(again)).mapInArrow(go, schema))


def term_counts(texts: DataFrame) -> DataFrame:
    """id, gram, n: tokens and neighbouring pairs of each text (id, text); rows of one id are one text."""
    counts = _by_text(texts, "grams array<string>, ns array<bigint>", lambda g: (list(g), list(g.values())), True, 1000)
    return counts.select("id", F.explode(F.arrays_zip("grams", "ns")).alias("g")).select("id", F.col("g.grams").alias("gram"), F.col("g.ns").alias("n"))


def _sparse(texts: DataFrame, dim: int, unit: bool) -> DataFrame:
    """id, idx, w of one row for each id, as arrays; ``unit`` has them normalised."""

    def row(g: Counter[str]) -> tuple:
        at, w = _cells(g, dim)
        return at, _unit(w) if unit else w

    return _by_text(texts, "idx array<int>, w array<double>", row, True, 2 * dim)


def hashed_sparse(texts: DataFrame, dim: int = DIM) -> DataFrame:
    """id, idx, w: the vectors before normalisation, without zeros that no gram fell on."""
    return _exploded(_sparse(texts, dim, False), "w")


def hashed_units(texts: DataFrame, dim: int = DIM, digits: int = 6) -> DataFrame:
    """id, idx, v: the same normalised, and rounded as vectors are stored."""
    return _exploded(_sparse(texts, dim, True), "v").withColumn("v", F.bround("v", digits))


def _exploded(cells: DataFrame, name: str) -> DataFrame:
    return cells.select("id", F.explode(F.arrays_zip("idx", "w")).alias("c")).select("id", F.col("c.idx").alias("idx"), F.col("c.w").alias(name))


def hashed_scores(texts: DataFrame, query: list[float], digits: int = 6) -> DataFrame:
    """id, score: the inner product of each text's vector, rounded as it is stored, with a query's, from the cells alone."""
    q = F.array(*(F.lit(float(x)) for x in query))
    cells = F.zip_with("idx", F.transform("w", lambda w: F.bround(w, digits)), lambda i, v: v * F.get(q, i))
    return _sparse(texts, len(query), True).filter(F.size("idx") > 0).select("id", F.aggregate(cells, F.lit(0.0), lambda s, x: s + x).alias("score"))


def hashed_vectors(texts: DataFrame, dim: int = DIM) -> DataFrame:
    """id, vector of each row, without a shuffle: normalised; a text without tokens has the zero vector."""

    def row(g: Counter[str]) -> tuple:
        out = np.zeros(dim)
        at, w = _cells(g, dim)
        out[at] = _unit(w)
        return (out,)

    return _by_text(texts, "vector array<double>", row, False, dim)


#: Name to a function (options) -> (function of a list of texts to a list of vectors).
PROVIDERS: dict[str, Callable[[dict], Callable[[list[str]], list[list[float]]]]] = {}


def register_provider(name: str, make: Callable[[dict], Callable[[list[str]], list[list[float]]]]) -> None:
    PROVIDERS[name] = make


class ServedModel:
    """A model behind HTTP.

    Options: url, model; single (one prompt a request, by the older endpoint), path, timeout in seconds, tries.  The wire format is the
    server's: a batch goes as {"model", "input": [...]} and comes back under "embeddings", a prompt as {"model", "prompt"} under "embedding"."""

    def __init__(self, options: dict):
        self.single = bool(options.get("single"))
        self.address = f"{options['url'].rstrip('/')}{options.get('path') or ('/api/embeddings' if self.single else '/api/embed')}"
        self.model, self.timeout, self.tries = options["model"], options.get("timeout", 120), options.get("tries", 3)

    def __call__(self, texts: list[str]) -> list[list[float]]:
        if self.single:
            return [self._ask({"prompt": t}, "embedding") for t in texts]
        found = self._ask({"input": texts}, "embeddings")
        if len(found) != len(texts):
            raise RuntimeError(f"{len(texts)} texts were sent to {self.address}, {len(found)} vectors came back")
        return found

    def _ask(self, what: dict, field: str):
        """One request; refused connections and server errors are tried again, with growing pauses."""
        import http.client
        import json
        import time
        from urllib import error, request

        for attempt in range(self.tries):
            try:
                sent = request.Request(self.address, json.dumps({"model": self.model} | what).encode(), {"Content-Type": "application/json"})
                with request.urlopen(sent, timeout=self.timeout) as reply:
                    body = json.load(reply)
                break
            except error.HTTPError as e:
                if e.code < 500 or attempt + 1 == self.tries:
                    raise RuntimeError(f"{self.address} refused with status {e.code}") from e
            except (error.URLError, http.client.HTTPException, TimeoutError) as e:
                if attempt + 1 == self.tries:
                    raise RuntimeError(f"{self.address} cannot be reached: {e}") from e
            time.sleep(0.2 * 2**attempt)
        if not isinstance(body.get(field), list) or not body[field]:
            raise RuntimeError(f"the reply of {self.address} holds no {field!r}")
        return body[field]


register_provider("http", ServedModel)


def model_vectors(texts: DataFrame, provider: str, options: dict | None = None, batch: int = 32) -> DataFrame:
    """id, vector by a registered provider, called with so many texts at a time from every task."""
    if provider not in PROVIDERS:
        raise ValueError(f"unknown provider {provider!r}; known: {', '.join(sorted(['hashed', *PROVIDERS]))}")
    make, options = PROVIDERS[provider], options or {}

    def go(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embed = make(options)
        for pdf in frames:
            vectors: list[list[float]] = []
            for k in range(0, len(pdf), batch):
                vectors += embed(pdf["text"].iloc[k : k + batch].tolist())
            yield pd.DataFrame({"id": pdf["id"], "vector": vectors})

    out = texts.select("id", "text").mapInPandas(go, "id string, vector array<double>")
    return out.withColumn("vector", V.l2_normalize("vector"))


def embed(texts: DataFrame, provider: str = "hashed", options: dict | None = None) -> DataFrame:
    """id, vector, rounded to six digits as vectors are stored."""
    options = options or {}
    raw = hashed_vectors(texts, options.get("dim") or DIM) if provider == "hashed" else model_vectors(texts, provider, options)
    return raw.withColumn("vector", V.round_vector("vector"))


def split_by_cache(chunks: DataFrame, cache: DataFrame, key: tuple[str, ...] = ("id", "text_hash", "provider", "model", "dim")) -> tuple[DataFrame, DataFrame]:
    """(reusable vectors, chunks that need one).  The default key notices changed texts and models; ("id",) does not."""
    on = list(key)
    return cache.join(chunks.select(*on), on, "left_semi"), chunks.join(cache.select(*on).distinct(), on, "left_anti")
