import random
import zlib
from collections import defaultdict

import numpy as np

from loomgraph.llm import packing, tokens
from loomgraph.llm.queries import WORD_BPE

from cases import documents, empty


def best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(bins) if r >= n]
        if fits:
            bins[min(fits)[1]] -= n
        else:
            bins.append(capacity - n)
    return sorted(bins)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(150):
        capacity = rng.choice([7, 16, 50])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        rows, placed = packing.plan(counts, capacity), defaultdict(list)
        for n, many in counts.items():
            own = rows[rows[:, 0] == n]
            for rank in range(many):
                _, first, b, per, at = own[own[:, 1] <= rank][-1]
                placed[b + (rank - first) // per].append((at + (rank - first) % per * n, n))
        for spans in placed.values():
            at = 0
            for start, n in sorted(spans):
                assert start == at
                at += n
        assert sorted(capacity - sum(n for _, n in s) for s in placed.values()) == best_fit(lengths, capacity)


def test_segment_tree():
    t = packing.Capacities(100)
    for r in (3, 50, 100):
        t.set(r, True)
    assert [t.tightest(n) for n in (1, 3, 4, 51, 100)] == [3, 3, 50, 100, 100]
    t.set(100, False)
    assert t.tightest(51) is None


def test_whole_table(spark):
    docs = documents(spark)
    out = packing.pack(docs.repartition(5), WORD_BPE, with_ids=True)
    rows = out.collect()
    lib = tokens.library(WORD_BPE)
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    for d in docs.collect():
        ids = np.array([*lib.encode(d["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted(by_doc[d["doc_id"]], key=lambda r: r["start"])
        if d["doc_id"] != 2:
            assert b"".join(bytes(r["ids"]) for r in own) == ids.tobytes()
            assert [r["piece"] for r in own] == list(range(len(own)))
        for r in own:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["length"] == len(part) <= 4096
    assert len(by_doc[2]) == 2
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in sequences.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
    assert sorted(4096 - sum(n for _, n in s) for s in sequences.values()) == best_fit([r["length"] for r in rows], 4096)
    whole = packing.sequences(out).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * sum(r["length"] for r in rows)
    assert packing.pack(empty(spark), WORD_BPE).count() == 0
