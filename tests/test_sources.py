"""Readers and writers on small files, a whole build, and the stream."""

import json

import pytest
from pyspark.sql import functions as F

from loomgraph.operators import linking
from loomgraph.sources import dataset
from loomgraph.sources import records as R
from loomgraph.sources import schemas as S
from loomgraph.streaming.ingest import ingest


def test_ndjson_skips_blanks_and_fails_on_garbage(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":"a","vector":[1]}\n\n  \n{"id":"b","vector":[2,3]}\n')
    assert R.ndjson(spark, str(tmp_path / "a.jsonl"), S.EMBEDDING).count() == 2
    (tmp_path / "b.jsonl").write_text('{"id":"a"}\nnot json\n')
    with pytest.raises(Exception):
        R.ndjson(spark, str(tmp_path / "b.jsonl"), S.EMBEDDING).collect()
    good, bad = R.ndjson_tolerant(spark, str(tmp_path / "b.jsonl"), S.EMBEDDING)
    assert (good.count(), [r["value"] for r in bad.collect()]) == (1, ["not json"])


def test_shards_of_both_shapes(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps([{"name": "A", "type": "Place"}]))
    (tmp_path / "2.json").write_text(json.dumps({"entities": [{"name": "B", "evidence": ["d::0001"]}]}))
    (tmp_path / "3.json").write_text("{broken")
    rows, bad = R.shards(spark, str(tmp_path))
    assert [r["name"] for r in rows.orderBy("pos").collect()] == ["A", "B"]
    assert bad.count() == 1


def test_transcripts(spark, tmp_path):
    use = lambda x: json.dumps({"message": {"content": [{"type": "text"}, {"type": "tool_use", "input": x}]}})
    lines = [use({"entities": [{"name": "A"}, {"name": "B"}]}), "junk", use({"entities": []}), use({"entities": [{"type": "x"}]}), json.dumps({"message": {"content": "text"}})]
    (tmp_path / "agent-1.jsonl").write_text("\n".join(lines))
    assert [r["name"] for r in R.transcripts(spark, str(tmp_path)).orderBy("pos").collect()] == ["A", "B"]


def test_keyed_documents_and_missing_files(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"a": {"title": "T", "chunks": 3}, "b": {}}))
    got = {r["slug"]: r["chunks"] for r in R.keyed(spark, str(tmp_path / "s.json"), S.SOURCE).collect()}
    assert got == {"a": 3, "b": None}
    assert R.keyed(spark, str(tmp_path / "none.json"), S.SOURCE, missing_ok=True).count() == 0
    with pytest.raises(ValueError):
        R.documents(spark)


def test_globs_are_relative_to_the_root(spark, tmp_path):
    for name in ("top.md", "a/b/x.md", "a/b/y z+1.md", "a/c/deep/w.md", "a/b/no.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    found = lambda g, root=str(tmp_path): {r["rel"]: r["text"] for r in R.documents(spark, glob=g, root=root).collect()}
    assert found("a/b/*.md") == {n: n for n in ("a/b/x.md", "a/b/y z+1.md")}
    assert found("**/*.md") == {n: n for n in ("top.md", "a/b/x.md", "a/b/y z+1.md", "a/c/deep/w.md")}
    assert found("a/**/w.md", f"file://{tmp_path}/") == {"a/c/deep/w.md": "a/c/deep/w.md"}
    with pytest.raises(Exception):
        found("a/x/*.md")


def test_manifests_tell_what_they_lack():
    assert dataset.absent({"dataset": {"id": "a", "name": "b"}, "ontology": {}, "content": {}, "embeddings": {"dim": 0, "metric": "cosine"}}) == ["dataset.version", "ontology.graph", "ontology.entity_index", "ontology.base_iri", "content.chunks_glob", "embeddings.vectors_glob"]


def test_build_describe_and_reread(spark, tmp_path):
    docs = spark.createDataFrame([("d", "# H\n" + "the Gift of fire " * 100)], "slug string, text string")
    ents = spark.createDataFrame([("k/G", ["k/type#Concept"], "Gift", ["Gift", "gift of Fire"], "", [])], "iri string, types array<string>, label string, aliases array<string>, summary string, tags array<string>")
    ev = spark.createDataFrame([("the gift", ["d::0000", "x"])], "name string, evidence array<string>")
    built = dataset.build(docs, ents, ents.select("iri").limit(0), ev)
    assert built.chunks.filter(F.size("entities") == 1).count() == 2
    e = built.entities.head()
    assert (e["attestedIn"], e["definedIn"]) == (["d"], ["d"])
    assert built.vectors.count() == 2
    m = dataset.describe(built, None, dataset.About("t", "T", "1", "k/"), "hashed", "h", 256)
    assert m["ontology"]["counts"] == {"entities": 1, "by_type": {"Concept": 1}} and m["content"]["counts"]["chunks"] == 2
    R.write_ndjson(built.chunks, str(tmp_path / "chunks"), "doc")
    back = spark.read.schema(S.CHUNK).json(str(tmp_path / "chunks"))
    assert back.count() == 2 and {r["doc"] for r in back.collect()} == {"d"}
    assert R.fingerprints(spark, str(tmp_path / "chunks" / "doc=d")).count() >= 1


def test_describing_does_not_embed(spark):
    """files_dataset: vectors were all made once to be counted, and again to be saved."""
    from loomgraph.operators import embedding

    def never(options):
        raise AssertionError("a text was embedded")

    embedding.register_provider("never", never)
    docs = spark.createDataFrame([("d", "the Gift of fire " * 100)], "slug string, text string")
    ents = spark.createDataFrame([("k/G", ["k/type#Concept"], "Gift", ["Gift"], "", [])], "iri string, types array<string>, label string, aliases array<string>, summary string, tags array<string>")
    built = dataset.build(docs, ents, ents.select("iri").limit(0), spark.createDataFrame([], "name string, evidence array<string>"), "never")
    assert dataset.describe(built, None, dataset.About("t", "T", "1", "k/"), "never", "n", 256)["embeddings"]["counts"] == {"vectors": 2}


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"slug": "a", "text": "word " * 300}))
    keys = linking.alias_keys(spark.createDataFrame([("i", ["word word"])], "iri string, aliases array<string>"))
    stream = spark.readStream.schema("slug string, text string").json(str(tmp_path / "in"))
    ingest(stream, keys, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "chunks")).count() == 2
    assert spark.read.parquet(str(tmp_path / "out" / "vectors")).count() == 2


def test_a_table_in_one_row_group_is_dealt_to_all_cores(spark, tmp_path):
    """Its splits are many, but one of them holds all rows; a table in many row groups is read as it lies."""
    import random

    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from loomgraph.plans import fixtures

    rng = random.Random(5)
    table = pa.table({"doc_id": pa.array([None if i % 3 else 7 for i in range(2000)], pa.int64()), "text": [f"{rng.random()} {i}" * 5 for i in range(2000)]})
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        for name, rows in (("one", 2000), ("many", 50)):
            pq.write_table(table, f"{tmp_path}/{name}.parquet", row_group_size=rows)
            read = fixtures.table(spark, str(tmp_path), name)
            assert read.rdd.getNumPartitions() >= 4
            dealt = fixtures.spread(read)
            held = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(held) == 2000 and max(held) <= 2 * 2000 / 4
            assert sorted(r["text"] for r in dealt.collect()) == sorted(table["text"].to_pylist())
            assert ("Exchange" in plan(dealt)) == (name == "one") and "RoundRobin" not in plan(dealt)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
