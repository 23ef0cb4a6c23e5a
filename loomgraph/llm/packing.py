"""Best-fit decreasing packing of documents into sequences.

Documents are encoded in place and cut into pieces; only (id, length, place) rows leave a task.  As best
fit looks at lengths alone, the plan for all pieces follows from the histogram of lengths, which has as
many entries as a sequence has tokens, however many documents there are.  The plan is made longest first:
a segment tree over the remaining capacities gives the tightest open bin for a length in logarithmic time,
and all pieces of one length that would go to bins alike are placed at once.  A piece finds its bin by its
rank among the pieces of its length, which comes from counts per task, so that no length is ever gathered
in one task.

Defined cases: a null text is empty; an empty text is one piece that holds the end token only; repeated
rows are packed each; an empty table gives an empty result; other columns, whatever their names, are ignored.  Very long
documents are cut into full pieces and a rest."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.llm import tokens
from loomgraph.llm.common import Stage, ship, small

CAPACITY, END_ID = 4096, 1


class Capacities:
    """A segment tree over remaining capacities 0..n: the smallest one at least so large that has open bins."""

    def __init__(self, n: int):
        self.leaves = 1 << n.bit_length()
        self.any = bytearray(2 * self.leaves)

    def set(self, r: int, there: bool) -> None:
        i = r + self.leaves
        self.any[i] = there
        while i > 1:
            i >>= 1
            now = self.any[2 * i] | self.any[2 * i + 1]
            if self.any[i] == now:
                return
            self.any[i] = now

    def tightest(self, least: int) -> int | None:
        i = least + self.leaves
        if self.any[i]:
            return least
        while i > 1:
            if not i & 1 and self.any[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, bin, pieces per bin, offset) in order of length and rank: from that rank on,
    every so many pieces of that length go to the bin, then to the next."""
    tree, rows, bins = Capacities(capacity), [], 0
    pools: dict[int, list[tuple[int, int]]] = {}  # remaining capacity: runs of bins

    def put(r: int, first: int, n: int) -> None:
        pool = pools.setdefault(r, [])
        if pool and pool[-1][0] + pool[-1][1] == first:
            pool[-1] = (pool[-1][0], pool[-1][1] + n)
        else:
            pool.append((first, n))
        if len(pool) == 1:
            tree.set(r, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            r = tree.tightest(length) if length <= capacity else None
            if r is None:
                r, first, n = capacity, bins, max(1, left // (capacity // length))
                bins += n
            else:
                first, n = pools[r].pop()
                if not pools[r]:
                    tree.set(r, False)
            per = min(left, r // length)
            fill = min(n, left // per)
            rows.append((length, rank, first, per, capacity - r))
            put(r - per * length, first, fill)
            if fill < n and r < capacity:
                put(r, first + fill, n - fill)
            rank, left = rank + fill * per, left - fill * per
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, the task and the rank within it among pieces of that length."""
    ship(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, task, seen = tokens.words_of("ids", path), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                ids = words(text) + end
                for k in range(0, len(ids), 4 * capacity):
                    part = ids[k : k + 4 * capacity]
                    n = len(part) // 4
                    rows.append((doc, k // (4 * capacity), k // 4, n, zlib.crc32(part), task, seen[n], *([part] if with_ids else [])))
                    seen[n] += 1
            yield pd.DataFrame(rows, columns=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", *(["ids"] if with_ids else [])]
    schema = "doc_id string, piece int, start long, length long, ids_crc32 long, task int, nth long" + ", ids binary" * with_ids
    # Ids travel as strings: pandas would turn integers with nulls among them to floats.
    cut = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(encode, schema)
    return cut.withColumn("doc_id", F.col("doc_id").cast("long"))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """A row per piece with its sequence and its offset there; with_ids adds the ids themselves."""
    spark = docs.sparkSession
    stage = Stage(spark, "packing")
    cut = stage.write(pieces(docs, path, capacity, end_id, with_ids), "pieces")
    per_task = stage.write(cut.groupBy("length", "task").agg(F.count("*").alias("n")), "counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(plan(counts, capacity))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        length, rank, first, per, offset = table.value.T
        key = length * (1 << 44) + rank
        for pdf in batches:
            n = pdf["length"].to_numpy()
            own = pdf.pop("rank").to_numpy()
            k = np.searchsorted(key, n * (1 << 44) + own, side="right") - 1
            pdf["sequence_id"] = first[k] + (own - rank[k]) // per[k]
            pdf["offset"] = offset[k] + (own - rank[k]) % per[k] * n
            yield pdf

    # Strings again for the same reason.
    before = F.sum("n").over(W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    starts = per_task.select(F.col("length").alias("l"), F.col("task").alias("t"), F.coalesce(before, F.lit(0)).alias("before"))
    ranked = cut.join(small(stage.write(starts, "starts")), (F.col("length") == F.col("l")) & (F.col("task") == F.col("t")))
    columns = [F.col("doc_id").cast("string"), "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    ranked = ranked.select(*columns, (F.col("nth") + F.col("before")).alias("rank"))
    schema = "doc_id string, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids + ", sequence_id long, offset long"
    return ranked.mapInPandas(place, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the ids of its pieces in order, of a result with ids."""
    whole = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return whole.select("sequence_id", F.concat(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")).alias("hex")).select("sequence_id", F.unhex("hex").alias("ids"))
