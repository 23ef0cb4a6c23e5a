"""Linking, packs, mentions, Turtle and checks."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from loomgraph.operators import checks, embedding, linking, mentions, ontology, packs, retrieval
from loomgraph.operators.components import components
from loomgraph.sources import turtle


def keys_of(spark, aliases):
    return linking.alias_keys(spark.createDataFrame([(i, [a]) for i, a in enumerate(aliases)], "iri int, aliases array<string>").withColumn("iri", F.col("iri").cast("string")))


def model(text, aliases):
    out = []
    for many in (True, False):
        ks = {a.lower() if many else a for a in aliases if (" " in a) == many and len(a) >= 3}
        if ks:
            body = "|".join(re.escape(k) for k in sorted(ks, key=lambda k: (-len(k), k)))
            out += [("words" if many else "word", h.lower() if many else h) for h in re.findall(rf"\b(?:{body})\b", text, re.I if many else 0)]
    return sorted(out)


def test_both_linkers_match_a_model(spark):
    rng = random.Random(3)
    aliases = ["of the", "the on", "on the end", "the", "The", "École un", "and", "x-ray", "an"]
    words = ["of", "the", "The", "on", "end", "école", "un", "and", "x-ray", "an", "ÉCOLE", "THE", "other"]
    texts = ["".join(w + rng.choice([" ", " ", "  ", ", ", "-"]) for w in rng.choices(words, k=30)) for _ in range(40)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, text string")
    k = keys_of(spark, aliases)
    for find in (linking.hits_by_pattern, linking.hits_by_grams):
        got = {}
        for r in find(df, k).collect():
            got.setdefault(r["id"], []).append((r["kind"], r["key"]))
        want = {str(i): m for i, t in enumerate(texts) if (m := model(t, [a for a in aliases]))}
        assert {i: sorted(h) for i, h in got.items()} == want, find


def test_grams_begin_where_a_key_of_their_shape_can(spark):
    """link_hits_by_grams: every run began a gram of every length, for both kinds."""
    x = spark.createDataFrame([("of the, on",), ("",), ("(a b",)], "text string").select(linking._runs("text").alias("__r"))
    at = lambda *shape: [[g["key"] for g in r[0]] for r in x.select(linking._grams(*shape)).collect()]
    assert at("words", 3, True) == [["of the", "the, on"], [], ["a b"]]
    assert at("word", 1, True) == [["of", "the", "on"], [], ["a", "b"]]
    assert at("word", 2, False) == [[" the", ", on"], [], [" b"]] and at("word", 2, True) == [["of ", "the, "], [], ["a "]]


def test_plain_words_are_looked_up(spark):
    """mentions: an alternation of all words was tried at every word, and the text copied for every match."""
    df = spark.createDataFrame([("a", "The end, the END the_end x22"), ("b", "")], "id string, text string")
    hits = linking.hits_by_pattern(df, keys_of(spark, ["end", "the", "x22"]))
    assert "regexp_extract_all" not in hits._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["id"], r["key"]) for r in hits.collect()] == [("a", "end"), ("a", "the"), ("a", "x22")]


def test_sources_come_with_the_chunks(spark, tmp_path):
    """dq_report, manifest_counts, files_batches: documents were read again, and their chunks joined to them, for a column."""
    from loomgraph.plans import fixtures

    spark.createDataFrame([(1, "src1", "on the way " * 20), (1, "src2", "on the way " * 20)], "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    df = fixtures.attested(spark, str(tmp_path))
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r["label"]: r["attestedIn"] for r in df.collect()}["on the"] == ["src1", "src2"]


def test_top_k_ties_and_bounds(spark):
    c = spark.createDataFrame([(x,) for x in "abcd"], "id string")
    v = spark.createDataFrame([("a", [1.0]), ("b", [1.0]), ("c", [0.5])], "id string, vector array<double>")
    assert [r["id"] for r in retrieval.top_k(c, v, [1.0], 2).orderBy("rank").collect()] == ["b", "a"]
    assert retrieval.top_k(c, v, [1.0], 0).count() == 0
    with pytest.raises(ValueError):
        retrieval.top_k(c, v, [1.0], -1)


def test_expansion_scores_missing_vectors_zero(spark):
    c = spark.createDataFrame([("a", ["x", "y"]), ("b", ["x", "x"]), ("c", ["x", "y"]), ("d", [])], "id string, entities array<string>")
    v = spark.createDataFrame([("a", [1.0]), ("b", [-1.0])], "id string, vector array<double>")
    hits = spark.createDataFrame([("a", 1)], "id string, rank int")
    rows = retrieval.expand(c, v, [1.0], hits, 5).orderBy("rank").collect()
    assert [(r["id"], r["overlap"], r["score"]) for r in rows] == [("c", 2, 0.0), ("b", 1, -1.0)]


def test_model_provider_is_called_in_batches(spark):
    embedding.register_provider("lengths", lambda o: lambda texts: [[float(len(t)), float(len(texts))] for t in texts])
    df = spark.createDataFrame([("a", "xy"), ("b", "")], "id string, text string").coalesce(1)
    got = {r["id"]: r["vector"] for r in embedding.model_vectors(df, "lengths").collect()}
    assert got["a"] == pytest.approx([2 / 8**0.5, 2 / 8**0.5])
    with pytest.raises(ValueError, match="unknown provider"):
        embedding.model_vectors(df, "nothing")


def test_closure_survives_cycles_and_unknown_packs(spark):
    p = spark.createDataFrame([("a", ["b"]), ("b", ["c", "x"]), ("c", ["a"]), ("d", [])], "slug string, requires array<string>")
    got = lambda *s: {r["pack"] for r in packs.closure(p, spark.createDataFrame([(x,) for x in s], "slug string")).collect()}
    assert got("a") == {"a", "b", "c", "x"} and got("d") == {"d"}
    assert {r["pack"] for r in packs.cyclic(p).collect()} == {"a", "b", "c"}
    with pytest.raises(ValueError, match="none"):
        packs.selection(p, spark.createDataFrame([("zz",)], "token string"))


def test_components_match_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)]
    parent = {x: x for e in edges for x in e if e[0] != e[1]}
    find = lambda x: x if parent[x] == x else find(parent[x])
    for a, b in edges:
        if a != b and find(a) != find(b):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {x: find(x) for x in parent}


def test_minting_is_sequential(spark):
    names, taken = ["A b", "a-b", "AB", "x", "A B", "AB 2"], ["AB_2", "X", "AB_02"]
    used, want = set(taken), []
    for n in names:
        base = "".join(p[:1].upper() + p[1:] for p in re.findall("[A-Za-z0-9]+", n))
        local, i = base, 2
        while local in used:
            local, i = f"{base}_{i}", i + 1
        used.add(local)
        want.append(local)
    df = spark.createDataFrame(list(enumerate(names)), "pos int, name string")
    got = mentions.mint(df, spark.createDataFrame([(t,) for t in taken], "local string")).orderBy("pos").collect()
    assert [r["local"] for r in got] == want


def test_turtle_parser_and_round_trip(spark):
    text = """@prefix k: <http://k/> . # comment
    k:a a k:T , k:U ; k:says "x \\"y\\" \\u00e9"@EN-gb, '''long
 "one"''' ; k:n 4, -1.5, true ; .
    PREFIX : <http://z/>
    :b k:to <rel> ."""
    rows = turtle.parse(text, "http://base/")
    assert ("http://k/a", turtle.RDF_TYPE, "http://k/U", True, None, None) in rows
    assert ("http://k/a", "http://k/says", 'x "y" é', False, "en-gb", None) in rows
    assert ("http://k/a", "http://k/says", 'long\n "one"', False, None, None) in rows
    assert ("http://z/b", "http://k/to", "http://base/rel", True, None, None) in rows
    for bad in ("k:a k:b k:c .", "<a> <b> [] .", "<a> <b> <c>", "<a> <b> ."):
        with pytest.raises(turtle.TurtleError):
            turtle.parse(bad)
    t = spark.createDataFrame([("http://k/a", "http://k/p", 'q "w"\\', False), ("http://k/a", "http://k/p", "http://k/o", True)], "s string, p string, o string, o_is_iri boolean")
    block = ontology.turtle(t).head()["block"]
    assert {r[:4] for r in turtle.parse(block)} == {tuple(r) for r in t.collect()}


def test_turtle_data_source(spark, tmp_path):
    turtle.register(spark)
    (tmp_path / "g.ttl").write_text("<http://a> <http://b> 'c' .")
    assert spark.read.format("turtle").load(str(tmp_path / "g.ttl")).select("s", "o").collect() == [("http://a", "c")]
    assert turtle.read_turtle(spark, str(tmp_path / "g.ttl")).count() == 1


def test_replaced_block_is_idempotent():
    once = ontology.replace_block("a", "# M", "b")
    assert ontology.replace_block(once, "# M", "b") == once == "a\n\n# M\n\nb\n\n# M (end)\n"
    both = ontology.replace_block(once, "# N", "c")
    again = ontology.replace_block(both, "# M", "new")
    assert again == both.replace("b\n", "new\n") and "# N\n\nc" in again  # blocks of later steps stay
    assert ontology.replace_block("a\n\n# M\n\nold", "# M", "b") == once


def test_a_block_that_does_not_parse_is_not_written(spark, tmp_path):
    path = str(tmp_path / "g.ttl")
    assert ontology.write_block(spark, path, "# M", "<http://a> <http://b> 'c' .") == 1
    before = (tmp_path / "g.ttl").read_text()
    with pytest.raises(turtle.TurtleError):
        ontology.write_block(spark, path, "# M", "<http://a> oops .")
    assert (tmp_path / "g.ttl").read_text() == before


def test_a_large_vocabulary_with_odd_ends_equals_a_model(spark):
    """20,000 aliases, some of which begin or end with other characters than a word's, against Python's regular expressions."""
    rng = random.Random(5)
    syllables = ["ka", "lo", "mi", "ra", "tu", "ne"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 3)))
    shapes = [lambda: word(), lambda: f"{word()} {word()}", lambda: f"{word()} ({word()})", lambda: f"({word()}", lambda: f"{word()}!", lambda: f"{word()} {word()} {word()}", lambda: f"{word()}-{word()}", lambda: f"{word()} & {word()}."]
    aliases = sorted({a for a in (rng.choice(shapes)() for _ in range(60_000)) if len(a) >= 3})[:20_000]
    assert len(aliases) > 15_000
    texts = [(i, " ".join(rng.choice([word(), word(), f"{word()} ({word()})x", f"{word()}!", f"{word()}-{word()}", "(" + word(), f"{word()} & {word()}.a", word().upper()]) for _ in range(40))) for i in range(60)]
    e = spark.createDataFrame([(f"i{k}", [a]) for k, a in enumerate(aliases)], "iri string, aliases array<string>")
    keys = linking.alias_keys(e)
    assert not linking.fits_pattern(keys)
    got = {r["id"]: r["entities"] for r in linking.with_entities(spark.createDataFrame(texts, "id long, text string"), keys).collect()}
    many = sorted({a.lower() for a in aliases if " " in a}, key=lambda a: (-len(a), a))
    single = sorted({a for a in aliases if " " not in a}, key=lambda a: (-len(a), a))
    by = {}
    for k, a in enumerate(aliases):
        by.setdefault((" " in a, a.lower() if " " in a else a), []).append(f"i{k}")
    some = 0
    for i, t in texts:
        found = {(True, m.lower()) for m in re.findall(r"(?i)\b(?:" + "|".join(map(re.escape, many)) + r")\b", t)}
        found |= {(False, m) for m in re.findall(r"\b(?:" + "|".join(map(re.escape, single)) + r")\b", t)}
        assert got[i] == sorted({iri for f in found for iri in by[f]})
        some += any(not f[1][-1].isalnum() for f in found)
    assert some > 10


def test_served_models_by_either_endpoint():
    import http.server
    import threading

    asked = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.path, body))
            if len(asked) == 1 or body["model"] == "bad":
                self.send_response(503 if len(asked) == 1 else 404)
                self.end_headers()
                return
            vector = lambda t: [float(len(t)), 1.0]
            out = {"embedding": vector(body["prompt"])} if "prompt" in body else {"embeddings": [vector(t) for t in body["input"]][: 1 if body["model"] == "short" else None]}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(out).encode())

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        options = {"url": f"http://127.0.0.1:{server.server_port}/", "model": "m"}
        assert embedding.ServedModel(options)(["a", "bb"]) == [[1.0, 1.0], [2.0, 1.0]]  # after a server error
        assert asked[-1] == ("/api/embed", {"model": "m", "input": ["a", "bb"]})
        assert embedding.ServedModel(options | {"single": True})(["ccc"]) == [[3.0, 1.0]]
        assert asked[-1] == ("/api/embeddings", {"model": "m", "prompt": "ccc"})
        for model in ("short", "bad"):
            with pytest.raises(RuntimeError):
                embedding.ServedModel(options | {"model": model})(["a", "bb"])
    finally:
        server.shutdown()


def test_checks_report_each_kind(spark):
    p = spark.createDataFrame([("a", ["zz"]), ("b", [])], "slug string, requires array<string>")
    e = spark.createDataFrame([("i", ["a"], ["b"]), ("j", ["q"], [])], "iri string, attestedIn array<string>, definedIn array<string>")
    c = spark.createDataFrame([("a", ["i", "gone", "gone"])], "doc string, entities array<string>")
    rows = checks.validate(p, e, c)
    got = {(r["check"], r["severity"], r["key"]) for r in rows.collect()}
    assert got == {("unknown_requires", "error", "a"), ("unknown_pack", "error", "j"), ("dangling", "error", ""), ("missing_chunks", "warning", "b"), ("defined_not_attested", "warning", "i")}
    assert tuple(checks.status(rows).head()) == (False, 3, 2)
    v = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0]), ("c", [2.0, 0.0]), ("d", [0.0, 0.0])], "id string, vector array<double>")
    assert {r["key"] for r in checks.bad_vectors(v, 2).collect()} == {"b", "c"}


def test_first_seen_reads_its_mentions_once(spark):
    """first_seen_entities: mentions were made anew for each of its five aggregates."""
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for pdf in frames:
            seen.add(len(pdf))
            yield pdf

    rows = [(f"p{i:02}", "The Ox " if i else "Ox", None if i % 3 else "Spell", ["Bull", "", "x" * 61, f"a{i}"], "" if i == 1 else "same", [f"c{i % 10}"]) for i in range(20)]
    kind = "pos string, name string, type string, aliases array<string>, description string, evidence array<string>"
    got = mentions.first_seen(spark.createDataFrame(rows, kind).mapInPandas(counted, kind)).collect()
    assert seen.value == 20
    assert [tuple(r) for r in got] == [("Ox", "Spell", ["Bull", "a0", "Ox", "a1", "The Ox", *(f"a{i}" for i in range(2, 9))], ["same"] * 6, [f"c{i}" for i in range(8)], 20)]
