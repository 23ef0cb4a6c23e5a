"""Queries on files: each writes the layout of a dataset from the tables to the shared folder, and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.operators import checks, chunking, embedding, linking, mentions, ontology
from loomgraph.operators import packs as P
from loomgraph.plans import fixtures as X
from loomgraph.plans.registry import query
from loomgraph.sources import dataset, turtle
from loomgraph.sources import records as R
from loomgraph.sources import schemas as S
from loomgraph.sources.staging import folder

# Records.


@query(f"WITH {X.CHUNKS} SELECT id, doc, seq, text, n_words, round_even(n_words * 1.3, 0)::INT AS token_est FROM ch")
def files_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """NDJSON in a folder for each pack, read through a glob."""
    at = folder(spark, "chunks")
    c = X.chunks(spark, sf, ["source"]).withColumn("entities", F.array().cast("array<string>"))
    R.write_ndjson(c, at, "source")
    return R.ndjson(spark, f"{at}/*/*.json", S.CHUNK).select("id", "doc", "seq", "text", "n_words", "token_est")


@query("SELECT printf('d%d::0000', vec_id) AS id, len(embedding)::INT AS n, round_even(list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))), 5) AS taxicab FROM embeddings")
def files_vectors(spark: SparkSession, sf: str) -> DataFrame:
    at = folder(spark, "vectors")
    R.write_ndjson(X.vectors(spark, sf).withColumn("part", F.pmod(F.hash("id"), F.lit(4))), at, "part")
    v = R.ndjson(spark, f"{at}/*/*.json", S.EMBEDDING)
    return v.select("id", F.size("vector").alias("n"), F.bround(F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.abs(x)), 5).alias("taxicab"))


@query(f"WITH {X.CHUNKS} SELECT id AS key, 'chunk: 2 rows' AS detail FROM ch WHERE source IN ('src1', 'src2')")
def files_duplicate_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Files that two globs name hold their ids twice."""
    at = folder(spark, "twice")
    R.write_ndjson(X.chunks(spark, sf, ["source"]), at, "source")
    both = [f"{at}/*/*.json", f"{at}/source=src[12]/*.json"]
    return checks.duplicate_ids(R.ndjson(spark, both[0], S.CHUNK).unionAll(R.ndjson(spark, both[1], S.CHUNK)), "chunk", "id").select("key", "detail")


@query("SELECT item_id, text || chr(10) AS text, CASE WHEN item_id % 2 = 0 THEN 'a/b' ELSE 'a/c' END AS folder FROM benchmark")
def files_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """Whole files by a glob below a root: nested folders count, files beside them do not."""
    at = folder(spark, "md")
    items = X.table(spark, sf, "benchmark")
    even = F.col("item_id") % 2 == 0
    for some, where in ((even, "a/b"), (~even, "a/c"), (F.lit(True), "d/b"), (F.lit(True), "a/bb")):
        items.filter(some).select("item_id", "text").write.partitionBy("item_id").text(f"{at}/{where}")
    found = R.documents(spark, glob="a/[bc]/*/*.txt", root=at)
    return found.select(F.regexp_extract("rel", "item_id=([0-9]+)", 1).cast("long").alias("item_id"), "text", F.regexp_extract("rel", "^(.*)/item_id=", 1).alias("folder"))


@query("SELECT item_id, strlen(text)::BIGINT + 1 AS bytes, sha256(text || chr(10)) AS sha256 FROM benchmark")
def files_listed(spark: SparkSession, sf: str) -> DataFrame:
    """The same by a list of folders, with sizes and hashes of the files as they are."""
    at = folder(spark, "listed")
    X.table(spark, sf, "benchmark").select("item_id", (F.col("item_id") % 2).alias("half"), "text").write.partitionBy("half", "item_id").text(at)
    paths = [f"{at}/half=0/*/*.txt", f"{at}/half=1/*/*.txt"]
    sizes = R.documents(spark, paths).select(F.regexp_extract("rel", "item_id=([0-9]+)", 1).cast("long").alias("item_id"), "bytes")
    hashes = R.fingerprints(spark, paths).select(F.regexp_extract("path", "item_id=([0-9]+)", 1).cast("long").alias("item_id"), "sha256")
    return sizes.join(hashes, "item_id")


# Mentions.

_SHARDS = """items AS (SELECT item_id, item_id // 5 AS shard, split_part(text, ' ', 1) AS name, split_part(text, ' ', 2) AS alias FROM benchmark)"""


def _items(spark: SparkSession, sf: str) -> DataFrame:
    w = F.split("text", " ")
    return X.table(spark, sf, "benchmark").select("item_id", F.floor(F.col("item_id") / 5).alias("shard"), F.get(w, F.lit(0)).alias("name"), F.get(w, F.lit(1)).alias("alias"))


def _entities_json(some: DataFrame, by: str) -> DataFrame:
    """by, body: the items of each shard as a JSON array of mentions, evidence among them that is no string."""
    m = F.struct("name", F.lit("Place").alias("type"), F.array("alias").alias("aliases"), F.lit("d").alias("description"), F.concat(F.lit("d"), "item_id", F.lit("::0001")).alias("evidence"))
    text = F.replace(F.to_json(m), F.lit('"evidence":'), F.lit('"evidence":[7,{"x":1},null,'))
    fixed = F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.lit("]}"))
    rows = some.select(by, F.struct("item_id", fixed.alias("t")).alias("x")).groupBy(by).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    return rows.select(by, F.concat(F.lit("["), F.array_join(F.transform("xs", lambda x: x["t"]), ","), F.lit("]")).alias("body"))


@query(f"""WITH {_SHARDS} SELECT shard::INT AS shard, row_number() OVER (PARTITION BY shard ORDER BY item_id)::INT - 1 AS i, name, 'Place' AS type, alias, 'd' || item_id || '::0001' AS evidence FROM items WHERE shard % 3 <> 2""")
def files_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Shards that are arrays, objects, or broken, in order of files; evidence that is no string is dropped."""
    at = folder(spark, "shards")
    body = F.when(F.col("shard") % 3 == 0, F.col("body")).when(F.col("shard") % 3 == 1, F.concat(F.lit('{"entities": '), "body", F.lit("}"))).otherwise(F.concat(F.lit("{broken "), "body"))
    _entities_json(_items(spark, sf), "shard").select("shard", body.alias("value")).write.partitionBy("shard").text(at)
    rows, _ = R.shards(spark, f"{at}/*/*.txt")
    return rows.select(F.regexp_extract("file", "shard=([0-9]+)", 1).cast("int").alias("shard"), "i", "name", "type", F.get("aliases", F.lit(0)).alias("alias"), F.array_join("evidence", " ").alias("evidence"))


@query(f"WITH {_SHARDS} SELECT DISTINCT shard::INT AS shard FROM items WHERE shard % 3 = 2")
def files_bad_shards(spark: SparkSession, sf: str) -> DataFrame:
    at = folder(spark, "bad-shards")
    body = F.when(F.col("shard") % 3 == 2, F.concat(F.lit("{broken "), "body")).otherwise(F.col("body"))
    _entities_json(_items(spark, sf), "shard").select("shard", body.alias("value")).write.partitionBy("shard").text(at)
    return R.shards(spark, f"{at}/*/*.txt")[1].select(F.regexp_extract("file", "shard=([0-9]+)", 1).cast("int").alias("shard"))


@query(f"""WITH {_SHARDS} SELECT shard::INT AS agent, row_number() OVER (PARTITION BY shard ORDER BY item_id)::INT AS nth, name, 'd' || item_id || '::0001' AS evidence FROM items WHERE item_id % 4 < 2""")
def files_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """Transcripts of agents: text blocks, junk lines and tool uses without entities between those that count, in order."""
    at = folder(spark, "transcripts")
    one = _entities_json(_items(spark, sf).withColumn("line", F.col("item_id")), "line")
    use = F.concat(F.lit('{"message":{"content":[{"type":"text","text":"t"},{"type":"tool_use","input":{"entities":'), "body", F.lit("}}]}}"))
    kind = F.col("line") % 4
    value = F.when(kind < 2, use).when(kind == 2, F.lit("junk {")).otherwise(F.lit('{"message":{"content":"x"}}'))
    lines = one.select(F.floor(F.col("line") / 5).alias("agent"), "line", value.alias("value"))
    lines.groupBy("agent").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]), "\n").alias("value")).write.partitionBy("agent").text(at)
    rows = R.transcripts(spark, f"{at}/*/*.txt").withColumn("agent", F.regexp_extract("file", "agent=([0-9]+)", 1).cast("int"))
    from pyspark.sql import Window as W

    return rows.select("agent", F.row_number().over(W.partitionBy("agent").orderBy("pos")).alias("nth"), "name", F.array_join("evidence", " ").alias("evidence"))


@query("SELECT count(*) FILTER (item_id % 3 <> 0) AS shards, coalesce(sum(CASE WHEN item_id % 3 = 1 THEN item_id END), 0)::BIGINT AS records FROM benchmark")
def files_written(spark: SparkSession, sf: str) -> DataFrame:
    """Reports of describers; null ones, and null counts, do not count."""
    i = F.col("item_id")
    reports = X.table(spark, sf, "benchmark").select(F.when(i % 3 != 0, F.concat(F.lit("s"), i.cast("string"))).alias("path"), F.when(i % 3 == 1, i).alias("written"))
    return mentions.written(reports)


# Batches, packs, prefixes.


@query(f"WITH {X.CHUNKS}, b AS (SELECT *, printf('%s__%03d', doc, seq // 120) AS batch_id FROM ch) SELECT source || '__' || (seq // 120) AS batch_id, count(*) AS n, max(length(text))::INT AS longest FROM b GROUP BY 1")
def files_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches are written in a folder each, and earlier ones go."""
    at = folder(spark, "batches")
    b = X.chunks(spark, sf, ["source"]).withColumn("batch_id", F.concat("source", F.lit("__"), F.floor(F.col("seq") / 120).cast("string")))
    R.write_batches(b.limit(0).withColumn("batch_id", F.lit("old")), at)
    R.write_batches(b, at)
    back = spark.read.schema(S.BATCH + ", batch_id string").json(at)
    return back.groupBy("batch_id").agg(F.count("*").alias("n"), F.max(F.length("text")).alias("longest"))


@query(f"WITH {X.PACKS} SELECT slug, title, 'content/' || slug AS path, array_to_string(requires, ' ') AS requires FROM packs")
def files_packs(spark: SparkSession, sf: str) -> DataFrame:
    """A registry as one JSON object keyed by slug."""
    at = folder(spark, "packs") + "/books.json"
    R.write_keyed(X.packs(spark, sf).select("slug", "title", F.concat(F.lit("content/"), "slug").alias("path"), "requires"), "slug", at)
    return P.registry(spark, at).select("slug", "title", "path", F.array_join("requires", " ").alias("requires"))


@query("SELECT source AS slug, min(lang) AS license, sum(coalesce(octet_length(encode(text)), 0))::BIGINT AS bytes FROM documents WHERE source IS NOT NULL GROUP BY source UNION ALL SELECT 'absent', NULL, 0")
def files_sources(spark: SparkSession, sf: str) -> DataFrame:
    """The same of sources, and of a file that is not there."""
    at = folder(spark, "sources") + "/sources.json"
    d = X.table(spark, sf, "documents").filter("source is not null").groupBy(F.col("source").alias("slug"))
    R.write_keyed(d.agg(F.min("lang").alias("license"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).cast("long").alias("bytes")), "slug", at)
    none = R.keyed(spark, at + ".none", S.SOURCE, missing_ok=True).agg(F.count("*").alias("bytes"))
    return R.keyed(spark, at, S.SOURCE).select("slug", "license", "bytes").unionAll(none.select(F.lit("absent"), F.lit(None).cast("string"), "bytes"))


@query(f"SELECT * FROM (VALUES ('kg', '{X.BASE}'), ('skos', '{ontology.SKOS}')) AS t(prefix, namespace)")
def files_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    at = folder(spark, "prefixes") + "/prefixes.json"
    R.write_document(spark.range(1).select(F.lit("not a prefix").alias("_comment"), F.lit(X.BASE).alias("kg"), F.lit(ontology.SKOS).alias("skos")), at)
    return R.prefixes(spark, at)


# A whole dataset.


@query(f"""WITH {X.LINKED}, {X.PACKS} SELECT '1' AS version, '{X.BASE}' AS base_iri, (SELECT count(*) FROM ch) AS chunks, (SELECT count(DISTINCT doc) FROM ch) AS documents,
(SELECT count(*) FROM ch) AS vectors, (SELECT count(*) FROM entities) AS entities, (SELECT count(*) FROM packs) AS packs, (SELECT string_agg(slug, ' ' ORDER BY slug) FROM packs WHERE len(requires) = 0) AS core,
(SELECT string_agg(type || '=' || n, ' ' ORDER BY type) FROM (SELECT split_part(t, '#', 2) AS type, count(*) AS n FROM (SELECT unnest(types) AS t FROM entities) GROUP BY 1)) AS by_type,
(SELECT count(*) FROM ch) AS read_chunks, (SELECT count(*) FROM links) AS read_links""")
def files_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Built, described, saved, found again through its manifest, and read."""
    at = folder(spark, "dataset")
    built = dataset.build(X.documents(spark, sf), X.entities(spark).drop("definedIn"), X.entities(spark).select("iri").limit(0), spark.createDataFrame([], "name string, evidence array<string>"))
    told = dataset.describe(built, X.packs(spark, sf), dataset.About("t", "Test", "1", X.BASE), "hashed", "hashed", embedding.DIM)
    dataset.save(spark, at, built, told, X.packs(spark, sf).withColumn("path", F.lit("p")))
    d = dataset.Dataset.open(spark, at)
    m = d.manifest
    types = " ".join(f"{k}={v}" for k, v in m["ontology"]["counts"]["by_type"].items())
    told = [m["dataset"]["version"], m["ontology"]["base_iri"], m["content"]["counts"]["chunks"], m["content"]["counts"]["documents"], m["embeddings"]["counts"]["vectors"], m["ontology"]["counts"]["entities"], d.packs().count(), " ".join(m["composition"]["core"]), types]
    one = spark.createDataFrame([told], "version string, base_iri string, chunks long, documents long, vectors long, entities long, packs long, core string, by_type string")
    read = d.chunks().agg(F.count("*").alias("read_chunks"), F.sum(F.size("entities")).alias("read_links"))
    return one.crossJoin(read)  # a row each


# Turtle.

_MARK = "# == provenance (generated) =="


@query(f"""WITH {X.PACKS}, b AS (SELECT slug, '{X.BASE}Book_' || upper(slug[1]) || slug[2:] AS s FROM packs)
SELECT s, '{ontology.RDF}type' AS p, unnest(['{X.BASE}Sourcebook', '{ontology.SCHEMA}Book']) AS o FROM b
UNION ALL SELECT s, '{ontology.DC}title', title FROM b JOIN packs USING (slug) UNION ALL SELECT s, '{X.BASE}bookSlug', slug FROM b
UNION ALL SELECT b.s, '{ontology.DC}requires', c.s FROM (SELECT slug, unnest(requires) AS r FROM packs) JOIN b USING (slug) JOIN b c ON c.slug = r
UNION ALL SELECT '{X.BASE}a', '{X.BASE}b', '{X.BASE}c'""")
def files_turtle(spark: SparkSession, sf: str) -> DataFrame:
    """A generated block replaces its earlier version in a graph, which is parsed before it is written, and read back."""
    at = folder(spark, "graph") + "/graph.ttl"
    R.put_text(spark, at, f"<{X.BASE}a> <{X.BASE}b> <{X.BASE}c> .\n")
    ontology.write_block(spark, at, _MARK, f"<{X.BASE}old> <{X.BASE}b> <{X.BASE}c> .")
    triples = ontology.provenance_triples(X.packs(spark, sf), X.entities(spark).limit(0).withColumn("attestedIn", F.array().cast("array<string>")), X.NAMES)
    known = ontology.vocabulary(spark, X.NAMES).select("s")
    blocks = ontology.turtle(triples.join(F.broadcast(known), "s", "left_anti")).orderBy("s").toPandas()["block"]  # packs only
    ontology.write_block(spark, at, _MARK, "\n".join(blocks))
    return turtle.read_turtle(spark, at).select("s", "p", "o")


_MINTED = f"""{X.ENTITIES}, {X.CHUNKS}, {X.MENTIONS}, {X.KEYED},
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY pos) AS r FROM keyed WHERE key NOT IN (SELECT {X.norm_sql('label')} FROM entities)) WHERE r = 1),
tm(t, class, tag, in_world, defined) AS (VALUES {", ".join(f"('{k}', '{c}', '{t}', {w}, {f"'{d}'" if d else 'NULL'})" for k, (c, t, w, d) in ontology.TYPE_MAP.items())}),
x AS (SELECT upper(name[1]) || name[2:] AS local, pos, name, class, tag, in_world, defined, regexp_replace(description, '\\s+', ' ', 'g') AS description, list_distinct(list_filter(list_transform(aliases, lambda a: trim(a)), lambda a: {X.norm_sql("a")} <> {X.norm_sql("name")})) AS others
  FROM once JOIN tm ON t = CASE WHEN type IN (SELECT t FROM tm) THEN type ELSE 'Concept' END)"""


@query(f"""WITH {_MINTED} SELECT '{X.BASE}' || local AS iri, 'kg:' || local || ' a ' || class || ' ;' || chr(10) || '    ' || CASE WHEN class = 'rpg:Tag' THEN 'skos:prefLabel' ELSE 'rpg:name' END || ' "' || name || '" ;' || chr(10)
  || '    dc:description "' || description || '" ;' || chr(10) || CASE WHEN len(others) > 0 THEN '    skos:altLabel ' || array_to_string(list_transform([o FOR o IN [' ' || name || ' one ', (SELECT other FROM listed WHERE key = name)] IF o IS NOT NULL AND {X.norm_sql("o")} <> {X.norm_sql("name")}], lambda o: '"' || trim(o) || '"'), ', ') || ' ;' || chr(10) ELSE '' END
  || CASE WHEN in_world THEN '    rpg:inWorld kg:World ;' || chr(10) ELSE '' END || CASE WHEN defined IS NOT NULL THEN '    ' || defined || ' kg:RuleSet ;' || chr(10) ELSE '' END || '    rpg:hasTag kg:' || tag || ' .' AS block FROM x""")
def turtle_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Extracted entities as Turtle statements."""
    m = mentions.mint(mentions.first_by_name(X.mentions(spark, sf), X.entities(spark).select(T.norm_name("label").alias("norm_name"))), spark.createDataFrame([], "local string"))
    return ontology.entity_blocks(m, X.NAMES).select("iri", "block")


@query(f"""WITH {_MINTED} SELECT DISTINCT tag, 'kg:' || tag || ' a rpg:Tag ; skos:prefLabel "' || CASE tag WHEN 'NamedSpell' THEN 'Named Spell' WHEN 'HermeticConcept' THEN 'Hermetic Concept' ELSE tag END || '" .' AS block FROM x WHERE tag <> 'Place'""")
def new_tags(spark: SparkSession, sf: str) -> DataFrame:
    m = mentions.first_by_name(X.mentions(spark, sf), X.entities(spark).select(T.norm_name("label").alias("norm_name")))
    return ontology.new_tags(m, spark.createDataFrame([("Place",)], "local string"), X.NAMES)


# Filters of graphs and names.


def _full_graph(spark: SparkSession) -> DataFrame:
    """The vocabulary as triples, with tags, and with what is no entity: a book, a property, a class, a foreign node, one without a label."""
    b = X.BASE
    tags = [(b + "OfThe", ontology.RPG + "hasTag", b + "tag/Pair"), (b + "Thin", ontology.RPG + "hasTag", b + "tag/Region"), (b + "Thin", ontology.RPG + "hasTag", b + "tag/Pair"), (b + "tag/Pair", ontology.SKOS + "prefLabel", "Pair"), (b + "tag/Region", ontology.RDFS + "label", "Region")]
    odd = [(b + "Book_X", b + "Sourcebook"), (b + "attestedIn", ontology.RDF + "Property"), (b + "Sourcebook", ontology.RDFS + "Class"), ("https://other.org/x", b + "type#Place")]
    rows = tags + [r for s, t in odd for r in ((s, ontology.RDF + "type", t), (s, ontology.RDFS + "label", "label"))] + [(b + "Bare", ontology.RDF + "type", b + "type#Place")]
    return ontology.entity_triples(X.entities(spark), X.NAMES).select("s", "p", "o").unionAll(spark.createDataFrame(rows, "s string, p string, o string"))


@query(f"""WITH {X.ENTITIES} SELECT iri, label, CASE label WHEN 'of the' THEN 'Pair' WHEN 'thin' THEN 'Pair Region' ELSE '' END AS tags FROM entities""")
def entity_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Only labelled, typed subjects of the dataset's own count; their tags come with labels."""
    return ontology.entity_index(_full_graph(spark), X.NAMES).select("iri", "label", F.array_join("tags", " ").alias("tags"))


@query(f"WITH {X.LINKED} SELECT id, iri FROM links WHERE iri <> '{X.BASE}The'")
def link_without_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Grouping nodes are not matched in texts."""
    graph = _full_graph(spark).unionAll(spark.createDataFrame([(X.BASE + "And", ontology.RPG + "hasTag", X.BASE + "The")], "s string, p string, o string"))
    keys = linking.alias_keys(X.entities(spark), ontology.categories(graph))
    c = linking.with_entities(X.chunks(spark, sf), keys)
    return c.select("id", F.explode("entities").alias("iri"))


@query(f"""SELECT item_id, '"' || trim(replace(replace(replace(text, '\\', '\\\\'), '"', '\\"'), chr(10), ' ')) || '"' AS esc, CASE WHEN item_id % 2 = 0 THEN 'n' || item_id END AS local,
  regexp_replace(regexp_replace(lower('Series One - ' || item_id), '^series one', ''), '[^a-z0-9]+', '', 'g') AS slug FROM benchmark""")
def names_and_escapes(spark: SparkSession, sf: str) -> DataFrame:
    iri = F.concat(F.when(F.col("item_id") % 2 == 0, F.lit(X.BASE)).otherwise(F.lit("https://other.org/")), F.lit("n"), "item_id")
    name = F.concat(F.lit("Series One - "), F.col("item_id").cast("string"), F.lit(".md"))
    return X.table(spark, sf, "benchmark").select("item_id", T.literal("text", fold=False).alias("esc"), T.local_in(iri, X.BASE).alias("local"), T.slugify(name, "Series One").alias("slug"))


@query(f"WITH {X.PACKS}, e AS (SELECT slug, unnest(list_append(requires, 'gone_' || slug)) AS r FROM packs) SELECT slug AS key, 'requires unknown pack ' || r AS detail FROM e WHERE r NOT IN (SELECT slug FROM packs)")
def dq_unknown_requires(spark: SparkSession, sf: str) -> DataFrame:
    more = X.packs(spark, sf).withColumn("requires", F.array_append("requires", F.concat(F.lit("gone_"), "slug")))
    return checks.unknown_requires(more).select("key", "detail")


@query(f"WITH {X.PACKS}, n AS (SELECT count(*) AS n FROM packs) SELECT n = 0 AS ok, n AS errors, 1::BIGINT AS warnings FROM n UNION ALL SELECT true, 0, 1 FROM n")
def dq_status(spark: SparkSession, sf: str) -> DataFrame:
    """A dataset passes if it has no errors; warnings do not count."""
    more = X.packs(spark, sf).withColumn("requires", F.array(F.concat(F.lit("gone_"), "slug")))
    bad, warn = checks.unknown_requires(more), spark.createDataFrame([("w", "warning", "k", "d")], "check string, severity string, key string, detail string")
    return checks.status(bad.unionAll(warn)).unionAll(checks.status(warn))


@query("SELECT doc_id::VARCHAR AS key, 'document.' || unnest(CASE WHEN doc_id % 10 = 0 THEN ['text', 'lang'] WHEN doc_id % 10 = 1 THEN ['lang'] ELSE [] END) AS detail FROM documents UNION ALL SELECT doc_id::VARCHAR, 'document.lang: ' || lang FROM documents WHERE lang NOT IN ('en', 'de')")
def dq_fields(spark: SparkSession, sf: str) -> DataFrame:
    d = X.table(spark, sf, "documents")
    i = F.col("doc_id") % 10
    holes = d.withColumns({"text": F.when(i != 0, F.col("text").substr(1, 1)), "lang": F.when(i > 1, F.col("lang"))}).withColumn("text", F.when(i != 0, F.coalesce("text", F.lit("")))).withColumn("lang", F.when(i > 1, F.coalesce("lang", F.lit("en"))))
    return checks.missing_fields(holes, "document", ["text", "lang"], "doc_id").unionAll(checks.bad_values(d, "document", "lang", ["en", "de"], "doc_id")).select("key", "detail")


@query(f"""WITH {X.CHUNKS}, {X.MENTIONS}, {X.KEYED}, ty AS (SELECT key, type, row_number() OVER (PARTITION BY key ORDER BY count(*) DESC, min(pos)) AS r FROM keyed WHERE type IS NOT NULL GROUP BY key, type),
al AS (SELECT key, a, min((pos, i)) AS seen FROM (SELECT key, pos, unnest(list_append(aliases, name)) AS a, generate_subscripts(list_append(aliases, name), 1) AS i FROM keyed) WHERE a <> '' AND length(a) <= 60 GROUP BY key, a),
ds AS (SELECT key, description, pos, row_number() OVER (PARTITION BY key ORDER BY pos) AS r FROM keyed WHERE description <> ''),
ev AS (SELECT key, x, min(pos) AS seen FROM (SELECT key, pos, unnest(evidence) AS x FROM keyed) GROUP BY key, x)
SELECT arg_min(name, pos) AS name, coalesce((SELECT type FROM ty WHERE ty.key = k.key AND r = 1), 'Concept') AS type, (SELECT array_to_string(list(a ORDER BY seen)[1:12], '|') FROM al WHERE al.key = k.key) AS aliases,
  (SELECT string_agg(description, '|' ORDER BY pos) FROM ds WHERE ds.key = k.key AND r <= 6) AS descriptions, (SELECT array_to_string(list(x ORDER BY seen)[1:8], ' ') FROM ev WHERE ev.key = k.key) AS evidence, count(*) AS mentions FROM keyed k GROUP BY key""")
def first_seen_entities(spark: SparkSession, sf: str) -> DataFrame:
    x = mentions.first_seen(X.mentions(spark, sf))
    return x.select("name", "type", F.array_join("aliases", "|").alias("aliases"), F.array_join("candidate_descriptions", "|").alias("descriptions"), F.array_join("evidence", " ").alias("evidence"), "mentions")


@query(f"WITH {X.CHUNKS} SELECT doc, count(*) AS n FROM ch GROUP BY doc")
def files_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """The canonical storage by part; a part that is written again replaces itself alone."""
    at = folder(spark, "parquet")
    c = chunking.batches(X.chunks(spark, sf)).withColumn("part", F.pmod(F.hash("doc"), F.lit(4)))
    R.write_parquet(c, at, "part")
    R.write_parquet(c.filter("part = 1"), at, "part")
    return spark.read.parquet(at).groupBy("doc").agg(F.count("*").alias("n"))
