"""What the vector searches share: usable vectors, a stored index of blocks of rows, blocks of queries, and the merge."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.llm.common import Stage, ship

#: Rows of a block of the index, and queries that are sent to all tasks at once.
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 16_384


def usable(table: DataFrame, zero: bool) -> DataFrame:
    """vec_id, embedding (doubles) without null ids, null vectors, or null or non-finite components; ``zero``: with zero vectors."""
    x = table.filter("vec_id is not null and embedding is not null").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    x = x.filter(F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))))
    return x if zero else x.filter(F.exists("embedding", lambda v: v != 0))


def matrix(vectors, dim: int) -> np.ndarray:
    """Rows of ``dim`` doubles; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), dim))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def blocks(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The batches of a task, joined to blocks."""
    held, n = [], 0
    for pdf in batches:
        while len(pdf):
            part, pdf = pdf.iloc[: rows - n], pdf.iloc[rows - n :]
            held.append(part)
            n += len(part)
            if n >= rows:
                yield pd.concat(held, ignore_index=True)
                held, n = [], 0
    if n:
        yield pd.concat(held, ignore_index=True)


class Best:
    """The k best (score, least id) of each query so far."""

    def __init__(self, n: int, k: int, kind: str):
        self.k, self.kind = k, kind
        self.ids: list[np.ndarray] = [np.zeros(0, np.int64)] * n
        self.scores: list[np.ndarray] = [np.zeros(0, kind)] * n

    def kth(self, i: int):
        """The k-th best score of a query, or None while it has fewer."""
        s = self.scores[i]
        return s[self.k - 1] if len(s) >= self.k else None

    def add(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(ids):
            return
        ids, scores = np.concatenate([self.ids[i], ids]), np.concatenate([self.scores[i], scores])
        best = np.lexsort((ids, -scores))[: self.k] if self.kind != "int64" else np.lexsort((ids, ~scores))[: self.k]  # -s overflows for the least integer
        self.ids[i], self.scores[i] = ids[best], scores[best]

    def rows(self, q_ids: np.ndarray) -> pd.DataFrame:
        n = [len(x) for x in self.ids]
        return pd.DataFrame({"query_id": np.repeat(q_ids, n), "vec_id": np.concatenate([np.zeros(0, np.int64), *self.ids]), "score": np.concatenate([np.zeros(0, self.kind), *self.scores])})


def search(table: DataFrame, every: int, k: int, zero: bool, kind: str, build: Callable, order: Column | None = None, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each query (vec_id divisible by ``every``; of repeated ids
    the least vector) among all rows with another id.

    ``build(ids, matrix)`` makes the index of a block: an object with ``search(query ids, query matrix, best)``, which adds to
    ``best`` whatever of the block can be among the k best.  Blocks are made once, of neighbours by ``order`` if given, and
    stored; each block of queries, of bounded size, is sent to all tasks and passes over the stored blocks, and a task
    carries the k-th scores found so far from block to block as bounds."""
    spark = table.sparkSession
    ship(spark)
    stage = Stage(spark, kind)
    rows = usable(table, zero)
    known = rows.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim")).head()
    n, dim = known["n"], known["dim"] or 0
    score_type = "int64" if zero else "float64"
    score_ddl = f"query_id long, vec_id long, score {'long' if zero else 'double'}"
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score " + score_ddl.rsplit(" ", 1)[1])
    parts = max(1, -(-n // block_rows))
    # Hashes part rows that are equal in the order, so that no value fills a partition.
    dealt = rows.repartition(parts) if order is None else rows.repartitionByRange(parts, order, F.xxhash64("vec_id")).sortWithinPartitions(order)

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in blocks(batches, block_rows):
            yield pd.DataFrame({"block": [pickle.dumps(build(pdf["vec_id"].to_numpy(np.int64), matrix(pdf["embedding"], dim)), 5)]})

    index = stage.write(dealt.mapInPandas(make, "block binary"), "index")
    asked = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = stage.write(asked, "queries")
    q_blocks = max(1, -(-asked.count() // block_queries))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)))

    def run(held):
        def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            q_ids, q = held.value
            best = Best(len(q_ids), k, score_type)
            for pdf in batches:
                for block in pdf["block"]:
                    pickle.loads(block).search(q_ids, q, best)
            yield best.rows(q_ids)

        return go

    out = None
    for b in range(q_blocks):
        some = asked.filter(F.col("part") == b).select("vec_id", "embedding").orderBy("vec_id").toPandas()
        held = spark.sparkContext.broadcast((some["vec_id"].to_numpy(np.int64), matrix(some["embedding"], dim)))
        found = stage.write(index.mapInPandas(run(held), score_ddl), f"found{b}")
        held.destroy()
        out = found if out is None else out.unionAll(found)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
