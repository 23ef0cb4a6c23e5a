import random
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from loomgraph.llm import mixing, quality, tokens
from loomgraph.llm.queries import WORD_BPE
from pyspark.sql import functions as F

import test_jaccard
import test_lines
import test_packing
import test_quality
from cases import BASE, documents


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    lines = "\n".join(f"line {i} of a passage that repeats in other documents" for i in range(6))
    docs = documents(spark, [(30, lines + "\nown end of thirty", "en", "s1"), (31, "own start of thirty one\n" + lines, "en", "s2")])
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages_keep_columns_and_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, folder)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name == "quality classifier":
            assert {r["doc_id"] for r in docs.collect()} == {1, 2, 3, 7, 8, 9, None, 10, 30, 31}
        if name == "line dedup":
            assert docs.filter("doc_id = 31").head()["text"] == "own start of thirty one"
            assert docs.filter("n_chars <> length(text)").count() == 0
        if name == "near duplicates":
            assert {r["doc_id"] for r in docs.collect()} == {1, 7, 9, 10, 30, 31}  # the row without an id is a near copy of 1
    assert docs.filter(F.col("doc_id").isNull()).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert packed.agg(F.sum("length")).head()[0] > 0


def test_run_and_empty_tables(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 0
    for t in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert BASE and corpus_pipeline.ORACLE_SQL is None


def test_rows_without_an_id_of_their_own_stay(spark):
    text = [" ".join(f"t{i}w{j}" for j in range(40)) for i in range(6)]
    rows = [(1, text[0]), (2, text[1]), (2, text[2]), (2, text[2]), (3, text[1]), (None, text[3]), (None, text[4]), (4, text[5])]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    near = corpus_pipeline.drop_near_duplicates(spark, df, "")
    near = spark.createDataFrame(near.collect(), df.schema)
    assert sorted(r["text"] for r in near.collect()) == sorted(text)
    assert near.filter("doc_id is null").count() == 2
    mixed = corpus_pipeline.mix_sources(spark, near, "").collect()
    assert {t for t in text for r in mixed if r["text"].split()[0] in t.split()} == set(text)
    assert len({r["doc_id"] for r in mixed if r["doc_id"] > 4}) == 2


def corpus(spark, folder):
    """Good and bad texts, near copies, passages of several lines that repeat, and five sources."""
    rng = random.Random(21)
    syllables = ["ta", "ri", "on", "the", "mel", "ka", "is", "of", "ne", "lu", "po"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 3)))
    passage = [" ".join(word() for _ in range(12)) for _ in range(3)]
    rows, labels = [], []
    for i in range(400):
        lines = [" ".join(word() for _ in range(rng.randint(6, 14))) for _ in range(rng.randint(3, 10))]
        if i % 10 == 3:
            lines[1:1] = passage
        if i % 10 == 5:
            lines = [" ".join(word() for _ in range(80))]
        if i % 10 == 7:
            lines = [rows[i - 2][1] + " " + word()]
        if i % 6 == 0:
            lines = [line.upper() + " !!!" for line in lines] if i % 12 else [f"{lines[0].split()[0]} " * 12] * len(lines)
        rows.append((i, "\n".join(lines), "en", f"s{rng.choice([0, 0, 1, 2, 3, 4])}"))
        if i % 7 < 4:
            labels.append((i, int(i % 6 > 0), 0))
    spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows, labels


def test_stages_equal_brute_force(spark, tmp_path):
    rows, labels = corpus(spark, str(tmp_path))
    docs, got = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        got[name] = docs.collect()

    truth = dict((i, q) for i, q, _ in labels)
    by_id = lambda rs: sorted(rs, key=lambda r: str(r[0]))
    known, rest = by_id(r for r in rows if r[0] in truth), [r for r in rows if r[0] not in truth]
    views = lambda rs: quality.features(*zip(*[(t, lang, s) for _, t, lang, s in rs]))[:2]
    held = np.array([quality.xxhash.xxh3_64_intdigest(str(r[0])) % 1000 < 1000 * quality.HELD_OUT for r in known])
    model = quality.co_train(views(known), np.array([truth[r[0]] for r in known], float), held, test_quality.Rows(*views(rest)))[0]
    score = np.round(model.scores(*views(rows))[2], 9)
    left = {r[0]: r[1] for r, p in zip(rows, score) if p >= quality.THRESHOLD}
    assert {r["doc_id"]: r["text"] for r in got["quality classifier"]} == left and 200 < len(left) < 400

    deduped = test_lines.model(left, 20)
    deduped = {d: t for d, t in deduped.items() if t or t == left[d]}
    assert {r["doc_id"]: r["text"] for r in got["line dedup"]} == deduped and deduped != left

    groups = test_jaccard.model(list(deduped.items()), 5, 80)
    alone = {d: t for d, t in deduped.items() if groups[d][1] == d}
    assert {r["doc_id"]: r["text"] for r in got["near duplicates"]} == alone and len(alone) < len(deduped)

    source, size, taken = {r[0]: r[3] for r in rows}, defaultdict(int), defaultdict(int)
    for d, t in alone.items():
        size[source[d]] += len(t.split())
    for r in got["source mix"]:
        assert set(r["text"].split()) <= set(alone[r["doc_id"]].split()) and len(r["text"].split()) <= 2 * len(alone[r["doc_id"]].split())
        taken[source[r["doc_id"]]] += len(r["text"].split())
    names = sorted(size)
    goal = mixing.targets([size[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5 * sum(size.values()), 2.0)
    assert all(abs(taken[s] - g) <= 2 * mixing.BLOCK for s, g in zip(names, goal))

    lib = tokens.library(WORD_BPE)
    lengths = {r["doc_id"]: len(lib.encode(r["text"], add_special_tokens=False).ids) + 1 for r in got["source mix"]}
    pieces = defaultdict(list)
    for r in got["best-fit packing"]:
        pieces[r["doc_id"]].append((r["start"], r["length"]))
    assert {d: sum(n for _, n in p) for d, p in pieces.items()} == lengths
    cut = [min(4096, n - a) for n in lengths.values() for a in range(0, n, 4096)]
    assert len({r["sequence_id"] for r in got["best-fit packing"]}) == len(test_packing.best_fit(cut, 4096))
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, got["best-fit packing"]))
