"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Each source gets a share of the words of all documents by its weight, at most ``cap`` times its own
size (what it cannot take is shared again by weight).  Its target is then turned into a whole number
of equal-token blocks: highest quotients first among the sources, and again among the shards of a
source.  A shard takes whole epochs of its blocks and, for the rest of its quota, as many blocks as it lacks:
its documents stand in a seeded order, and the blocks follow one another round from a seeded start, so that the choice
is a random one of documents of which two a shard at most are cut.

Everything per document is a window within (source, shard) and integer arithmetic.  Rows with equal doc_id and size are
counted first, and dealt to shards in runs of ``SAME``, so that neither rows without a doc_id nor a repeated one fill a
shard.  The driver sees one row per source and per shard; ``MAX_SHARDS`` bounds the latter: beyond 2^28 documents a
source, its shards grow instead (they are sorted, with spilling, never held).

Defined cases: a null text has size 0 and takes 0; a null source is a source of its own, last in
order; sources without words get target 0; repeated rows, and rows without a doc_id, are documents of their own; an empty table
gives an empty result.  Other columns of the input, whatever their names, are ignored by ``mix`` and kept as they are by
``apply_mix`` (but for ``n_chars``, which follows the text).  ``apply_mix`` asks for a doc_id of its own for every row."""

from __future__ import annotations

import heapq
import math
import random
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.llm.common import WORD, Stage, lean, small

#: Words of a block; a shard's blocks differ by one word at most.
BLOCK = 16
#: Documents of a shard, until a source has MAX_SHARDS of them; equal rows that stay together.
SHARD_DOCS, MAX_SHARDS, SAME = 4096, 65_536, 512
SEED = 20_240_607


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, cap: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``cap`` times its size; excess is shared again by weight."""
    out, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while free:
        unit = left / math.fsum(weights[i] for i in free)
        full = {i for i in free if weights[i] * unit > cap * sizes[i]}
        if not full:
            for i in free:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = cap * sizes[i]
        left -= math.fsum(out[i] for i in full)
        free -= full
    return out


def sainte_lague(weights: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Seats by highest quotients w / (2 s + 1), at most ``most`` each; ties go to the earlier.

    A divisor found by bisection gives all but the last few seats at once; the heap deals those."""
    w, top = np.asarray(weights, float), np.asarray(most, np.int64)
    seats = int(min(seats, top[w > 0].sum())) if len(w) else 0
    if seats <= 0:
        return [0] * len(w)
    dealt = lambda d: np.minimum(np.floor(w / d + 0.5), top).astype(np.int64)
    low, high = w.max() / (2.0 * seats + 2), 2.0 * w.max() + 1
    while dealt(low).sum() < seats:
        low /= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (low, mid) if dealt(mid).sum() <= seats else (mid, high)
    s = dealt(high * (1 + 1e-9))  # equal quotients are left to the heap
    if (over := int(s.sum()) - seats) > 0:  # only by rounding of the divisor
        for i in np.argsort(w / np.maximum(2 * s - 1, 1), kind="stable")[:over]:
            s[i] -= 1
    heap = [(-w[i] / (2 * s[i] + 1), i) for i in range(len(w)) if w[i] > 0 and s[i] < top[i]]
    heapq.heapify(heap)
    for _ in range(seats - int(s.sum())):
        _, i = heapq.heappop(heap)
        s[i] += 1
        if s[i] < top[i]:
            heapq.heappush(heap, (-w[i] / (2 * s[i] + 1), i))
    return [int(x) for x in s]


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), ratio: float = 1.5, cap: float = 2.0, block: int = BLOCK) -> DataFrame:
    """doc_id, size, source_size, target, taken, and what is taken: ``epochs`` whole copies and the word
    ranges ``spans`` (start, end) of one more."""
    spark = docs.sparkSession
    stage = Stage(spark, "mixing")
    sized = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    sized = stage.write(sized.groupBy("source", "doc_id", "size").agg(F.count("*").alias("copies")), "sizes")

    rows = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("words"), F.sum("copies").alias("docs")).collect()
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    share = [weights[i % len(weights)] for i in range(len(rows))]
    goal = targets([r["words"] for r in rows], share, ratio * sum(r["words"] for r in rows), cap)
    kinds = spark.createDataFrame(
        [(r["source"], i, r["words"], g, max(1, min(MAX_SHARDS, -(-r["docs"] // SHARD_DOCS)))) for i, (r, g) in enumerate(zip(rows, goal, strict=True))],
        "kind string, sid int, source_size long, target double, shards int",
    )
    dealt = sized.join(small(kinds), F.col("source").eqNullSafe(F.col("kind")))
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / SAME).cast("long")))
    dealt = dealt.withColumn("run", run).withColumn("copies", F.least(F.lit(SAME).cast("long"), F.col("copies") - F.col("run") * SAME))
    order = F.xxhash64("doc_id", "size", "run", F.lit(SEED))
    dealt = dealt.withColumn("order", order).withColumn("shard", F.pmod(F.xxhash64("order"), F.col("shards")).cast("int"))
    place = W.partitionBy("sid", "shard").orderBy("order", "doc_id", "size", "run").rowsBetween(W.unboundedPreceding, 0)
    placed = dealt.withColumn("first", F.sum(F.col("size") * F.col("copies")).over(place) - F.col("size") * F.col("copies"))
    placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    placed = placed.withColumn("start", F.col("first") + F.col("copy") * F.col("size")).withColumn("stop", F.col("start") + F.col("size"))

    shards = dealt.groupBy("sid", "shard").agg(F.sum(F.col("size") * F.col("copies")).alias("w")).collect()
    plan = small(spark.createDataFrame(_plan(shards, goal, block, cap), "p_sid int, p_shard int, epochs int, a long, b long, c long"))
    x = placed.join(plan, (F.col("sid") == F.col("p_sid")) & (F.col("shard") == F.col("p_shard")))
    span = lambda a, b: F.struct((F.greatest("start", a) - F.col("start")).alias("start"), (F.least("stop", b) - F.col("start")).alias("stop"))
    # One more copy of the words from a to b, and of those before c where the blocks come round.
    both = F.filter(F.array(span(F.lit(0), "c"), span("a", "b")), lambda p: p["stop"] > p["start"])
    x = x.withColumn("epochs", F.when(F.col("size") > 0, F.col("epochs")).otherwise(0)).withColumn("spans", both)
    taken = F.col("epochs") * F.col("size") + F.aggregate("spans", F.lit(0).cast("long"), lambda t, p: t + p["stop"] - p["start"])
    return x.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "epochs", "spans")


def _plan(shards: list, goal: Sequence[float], block: int, cap: float) -> list[tuple]:
    """For each shard its whole epochs, and the ranges of words (a, b) and (0, c) of one more."""
    shards = sorted(((r["sid"], r["shard"], int(r["w"])) for r in shards))
    count = [max(1, round(w / block)) if w else 0 for _, _, w in shards]
    by: dict[int, list[int]] = {}
    for k, (sid, _, _) in enumerate(shards):
        by.setdefault(sid, []).append(k)
    seats = sainte_lague(goal, round(math.fsum(goal) / block), [int(cap * sum(count[k] for k in by.get(i, ()))) for i in range(len(goal))])
    quota = [0] * len(shards)
    for sid, ks in by.items():
        for k, q in zip(ks, sainte_lague([shards[k][2] for k in ks], seats[sid], [int(cap * count[k]) for k in ks]), strict=True):
            quota[k] = q
    return [(sid, shard, *_ranges(w, n, q, f"{sid}/{shard}")) for (sid, shard, w), n, q in zip(shards, count, quota, strict=True)]


def _ranges(words: int, blocks: int, quota: int, key: str) -> tuple[int, int, int, int]:
    """Blocks j = 0, 1, ... hold the words from j * words // blocks on."""
    if not blocks:
        return 0, 0, 0, 0
    first, rest = random.Random(f"{SEED}/{key}").randrange(blocks), quota % blocks
    at = lambda j: j * words // blocks
    return quota // blocks, at(first), at(min(blocks, first + rest)), at(max(0, first + rest - blocks))


def apply_mix(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mixed documents themselves, with the columns of ``docs``: a document's text becomes its whole
    copies and the words of its spans, parted by blank lines, so that it has ``taken`` words; documents
    of which nothing is taken go, and so do rows without a doc_id; columns beginning with two underscores are not looked at."""
    word = re.compile(WORD)

    def one(text: str, epochs: int, spans: list[dict]) -> str:
        parts = [text] * epochs
        if spans:
            at = [m.span() for m in word.finditer(text)]
            parts += [text[at[s["start"]][0] : at[s["stop"] - 1][1]] for s in spans]
        return "\n\n".join(parts)

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            texts = [one(*row) for row in zip(columns["text"].to_pylist(), columns.pop("__epochs").to_pylist(), columns.pop("__spans").to_pylist(), strict=True)]
            columns["text"] = pa.array(texts, batch.schema.field("text").type)
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([len(t) for t in texts], pa.int64()).cast(batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    some = mixed.filter("taken > 0").select("doc_id", F.col("epochs").alias("__epochs"), F.col("spans").alias("__spans"))
    joined = docs.filter(F.col("text").isNotNull()).join(some, "doc_id").select(*docs.columns, "__epochs", "__spans")
    return joined.mapInArrow(cut, docs.schema)
