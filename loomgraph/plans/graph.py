"""Queries on packs, quality, mentions and the ontology."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.operators import checks, mentions, ontology
from loomgraph.operators import packs as P
from loomgraph.operators.components import components as connected
from loomgraph.plans import fixtures as X
from loomgraph.plans.registry import query
from loomgraph.sources.staging import reliable

# Packs.

CLOSED = f"WITH RECURSIVE {X.PACKS}, deps AS (SELECT slug AS pack, unnest(requires) AS requires FROM packs), c AS (SELECT slug AS origin, slug AS pack FROM packs UNION SELECT origin, requires FROM c JOIN deps USING (pack))"


@query(f"{CLOSED} SELECT origin, pack FROM c")
def pack_closure(spark: SparkSession, sf: str) -> DataFrame:
    p = X.packs(spark, sf)
    return P.reachable(P.edges(p), p.select(F.col("slug").alias("origin"), F.col("slug").alias("pack")))


@query(f"{CLOSED} SELECT DISTINCT pack FROM c WHERE origin IN ('src13', 'src6')")
def pack_selection_closure(spark: SparkSession, sf: str) -> DataFrame:
    return P.closure(X.packs(spark, sf), spark.createDataFrame([("src13",), ("src6",)], "slug string"))


@query(f"{CLOSED} SELECT DISTINCT origin AS pack FROM c WHERE pack = 'src3'")
def pack_dependants(spark: SparkSession, sf: str) -> DataFrame:
    return P.dependants(X.packs(spark, sf), spark.createDataFrame([("src3",)], "slug string"))


@query(f"WITH {X.PACKS} SELECT slug FROM packs WHERE len(requires) = 0")
def pack_roots(spark: SparkSession, sf: str) -> DataFrame:
    return P.roots(X.packs(spark, sf))


LOOPED = f"WITH RECURSIVE {X.PACKS}, deps AS (SELECT slug AS pack, unnest(requires) AS requires FROM packs UNION ALL SELECT 'src1', 'src5'), c AS (SELECT pack AS origin, requires AS pack FROM deps UNION SELECT origin, requires FROM c JOIN deps USING (pack))"


def _looped(spark: SparkSession, sf: str) -> DataFrame:
    """With one edge more, which closes a cycle."""
    extra = F.when(F.col("slug") == "src1", F.array_append("requires", F.lit("src5"))).otherwise(F.col("requires"))
    return X.packs(spark, sf).withColumn("requires", extra)


@query(f"{LOOPED} SELECT DISTINCT pack FROM c WHERE origin = pack")
def pack_cycles(spark: SparkSession, sf: str) -> DataFrame:
    return P.cyclic(_looped(spark, sf))


TOKENS = ["src1", "src12", " src0 ", "c19", "7", "nowhere", "", "rc1"]


@query(f"""WITH {X.PACKS}, t AS (SELECT DISTINCT trim(token) AS token FROM (SELECT unnest({TOKENS}) AS token) WHERE trim(token) <> ''),
g AS (SELECT token, count(slug) AS n, max(CASE WHEN slug = token THEN slug END) AS same, max(slug) AS any_slug FROM t LEFT JOIN packs ON contains(slug, token) GROUP BY token)
SELECT token, CASE WHEN same IS NOT NULL THEN same WHEN n = 1 THEN any_slug END AS slug, CASE WHEN same IS NOT NULL THEN 'exact' WHEN n = 1 THEN 'unique' WHEN n = 0 THEN 'none' ELSE 'ambiguous' END AS status FROM g""")
def pack_resolve(spark: SparkSession, sf: str) -> DataFrame:
    return P.resolve(X.packs(spark, sf), spark.createDataFrame([(t,) for t in TOKENS], "token string"))


SCOPE = f"{CLOSED}, {X.LINKED}, {X.ATTESTED}, scope AS (SELECT DISTINCT pack FROM c WHERE origin IN ('src3', 'src12'))"


def _tokens(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("src3",), ("c12",)], "token string")


@query(f"{SCOPE} SELECT iri FROM attested WHERE len(definedIn) = 0 OR len(list_intersect(attestedIn, (SELECT list(pack) FROM scope))) > 0")
def scope_entities(spark: SparkSession, sf: str) -> DataFrame:
    p = X.packs(spark, sf)
    return P.entities_in_scope(X.attested(spark, sf), P.closure(p, P.selection(p, _tokens(spark)))).select("iri")


@query(f"""{SCOPE}, n AS (SELECT source AS slug, count(*) AS chunks FROM ch GROUP BY source)
SELECT array_to_string((SELECT list_sort(list(pack)) FROM scope), ' ') AS closure, 'src12 src3' AS selected, (SELECT count(*) FROM scope)::INT AS packs, (SELECT sum(chunks) FROM n JOIN scope ON slug = pack)::INT AS chunks,
(SELECT count(*) FROM attested WHERE len(definedIn) = 0 OR len(list_intersect(attestedIn, (SELECT list(pack) FROM scope))) > 0)::INT AS entities_in_scope,
(SELECT count(*) FROM attested WHERE len(definedIn) = 0)::INT AS spine_entities, (SELECT count(*) FROM attested WHERE len(definedIn) > 0)::INT AS book_entities_total,
(SELECT count(*) FROM attested WHERE len(definedIn) > 0 AND len(list_intersect(attestedIn, (SELECT list(pack) FROM scope))) > 0)::INT AS book_entities_in_scope""")
def composed_counts(spark: SparkSession, sf: str) -> DataFrame:
    n = X.chunks(spark, sf, ["source"]).groupBy(F.col("source").alias("slug")).agg(F.count("*").alias("chunks"))
    view = P.compose(X.packs(spark, sf), X.attested(spark, sf), n, _tokens(spark))
    return view.select(F.array_join("closure", " ").alias("closure"), F.array_join("selected", " ").alias("selected"), "counts.*")


# Data quality.


@query(f"WITH {X.LINKED} SELECT count(*) AS \"references\" FROM (SELECT unnest(entities) AS iri FROM linked) WHERE iri NOT IN (SELECT iri FROM entities WHERE label <> 'thin')")
def dq_dangling(spark: SparkSession, sf: str) -> DataFrame:
    return checks.dangling(X.linked(spark, sf), X.entities(spark).filter("label <> 'thin'"))


@query(f"WITH {X.LINKED}, {X.ATTESTED}, {X.PACKS}, s AS (SELECT iri, 'attestedIn' AS slot, unnest(attestedIn) AS slug FROM attested UNION ALL SELECT iri, 'definedIn', unnest(definedIn) FROM attested) SELECT iri AS key, slot || ' names unknown pack ' || slug AS detail FROM s WHERE slug NOT IN (SELECT slug FROM packs)")
def dq_unknown_pack(spark: SparkSession, sf: str) -> DataFrame:
    return checks.unknown_packs(X.attested(spark, sf), X.packs(spark, sf)).select("key", "detail")


@query(f"WITH {X.LINKED}, {X.ATTESTED} SELECT iri AS key FROM attested WHERE len(definedIn) > 0 AND len(list_intersect(definedIn, attestedIn)) = 0")
def dq_defined_not_attested(spark: SparkSession, sf: str) -> DataFrame:
    return checks.defined_not_attested(X.attested(spark, sf)).select("key")


@query(f"""{LOOPED}, {X.LINKED}, {X.ATTESTED}, s AS (SELECT iri, unnest(attestedIn) AS slug FROM attested UNION ALL SELECT iri, unnest(definedIn) FROM attested)
SELECT 'cycle' AS "check", 'error' AS severity, count(*) AS n FROM (SELECT DISTINCT pack FROM c WHERE origin = pack) HAVING count(*) > 0
UNION ALL SELECT 'unknown_pack', 'error', count(*) FROM s WHERE slug NOT IN (SELECT slug FROM packs) HAVING count(*) > 0
UNION ALL SELECT 'defined_not_attested', 'warning', count(*) FROM attested WHERE len(definedIn) > 0 AND len(list_intersect(definedIn, attestedIn)) = 0 HAVING count(*) > 0
UNION ALL SELECT 'missing_chunks', 'warning', count(*) FROM packs WHERE slug NOT IN (SELECT source FROM ch) HAVING count(*) > 0""")
def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    c = X.links(spark, sf)
    found = reliable(X.attested(spark, sf, c))
    return checks.validate(reliable(_looped(spark, sf)), found, c.withColumnRenamed("source", "doc")).groupBy("check", "severity").agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (len(embedding) <> 64 OR abs(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1) > 1e-3) AS bad FROM embeddings")
def dq_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return checks.bad_vectors(X.vectors(spark, sf), 64).agg(F.count("*").alias("bad"))


# Mentions.

COUNTED = f"WITH {X.CHUNKS}, {X.MENTIONS}, {X.KEYED}"


@query(f"{COUNTED}, n AS (SELECT key, name, count(*) AS n, min(pos) AS p FROM keyed GROUP BY key, name) SELECT key, name FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, p) AS r FROM n) WHERE r = 1")
def mention_mode(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.mode(mentions.keyed(X.mentions(spark, sf)), "key", "name", F.col("pos"))


EDGES = f"""WITH RECURSIVE {X.CHUNKS}, {X.MENTIONS}, {X.KEYED},
al AS (SELECT DISTINCT key, trim(a) AS alias FROM (SELECT key, unnest(aliases) AS a FROM keyed) WHERE a <> '' AND length(a) <= 60),
e AS (SELECT DISTINCT key AS a, {X.norm_sql("alias")} AS b FROM al),
edges AS (SELECT a, b FROM e WHERE length(b) >= 4 AND a <> b AND b IN (SELECT key FROM keyed)),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT a AS node, a AS other FROM both_ways UNION SELECT node, b FROM reach JOIN both_ways ON other = a),
comps AS (SELECT node, min(other) AS component FROM reach GROUP BY node)"""


@query(f"{EDGES} SELECT node, component FROM comps")
def components(spark: SparkSession, sf: str) -> DataFrame:
    return connected(mentions.merge_edges(mentions.keyed(X.mentions(spark, sf))))


@query(f"""{EDGES},
grp AS (SELECT key, min(pos) AS gp FROM keyed GROUP BY key),
m AS (SELECT k.*, gp, coalesce(component, k.key) AS entity FROM keyed k JOIN grp USING (key) LEFT JOIN comps ON node = k.key),
nm AS (SELECT entity, name, count(*) AS n, min((gp, pos)) AS p FROM m GROUP BY entity, name),
nm1 AS (SELECT entity, name FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY n DESC, p) AS r FROM nm) WHERE r = 1),
ty AS (SELECT entity, type, count(*) AS n, min((gp, pos)) AS p FROM m WHERE type IS NOT NULL GROUP BY entity, type),
ty1 AS (SELECT entity, type FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY n DESC, p) AS r FROM ty) WHERE r = 1),
ds AS (SELECT entity, substr(regexp_replace(description, '\\s+', ' ', 'g'), 1, 500) AS description FROM (SELECT entity, description, row_number() OVER (PARTITION BY entity ORDER BY length(description) DESC, gp, pos) AS r FROM m WHERE description <> '') WHERE r = 1),
ev AS (SELECT entity, list_sort(list(DISTINCT x))[1:5] AS evidence FROM (SELECT entity, unnest(evidence) AS x FROM m) GROUP BY entity),
aa AS (SELECT entity, list_sort(list(DISTINCT alias) FILTER ({X.norm_sql("alias")} <> {X.norm_sql("name")}))[1:8] AS aliases FROM (SELECT DISTINCT entity, trim(a) AS alias FROM (SELECT entity, unnest(aliases) AS a FROM m) WHERE a <> '' AND length(a) <= 60) JOIN nm1 USING (entity) GROUP BY entity)
SELECT name, coalesce(type, 'Concept') AS type, array_to_string(coalesce(aliases, []), ' ') AS aliases, coalesce(description, '') AS description, array_to_string(evidence, ' ') AS evidence, mentions
FROM (SELECT entity, count(*) AS mentions FROM m GROUP BY entity) JOIN nm1 USING (entity) LEFT JOIN ty1 USING (entity) LEFT JOIN ds USING (entity) LEFT JOIN ev USING (entity) LEFT JOIN aa USING (entity)""")
def canonical_entities(spark: SparkSession, sf: str) -> DataFrame:
    x = mentions.canonical(X.mentions(spark, sf))
    return x.withColumns({"aliases": F.array_join("aliases", " "), "evidence": F.array_join("evidence", " ")})


@query(f"{COUNTED} SELECT key, arg_min(description, (-length(description), pos)) AS description FROM keyed WHERE description <> '' GROUP BY key")
def longest_desc(spark: SparkSession, sf: str) -> DataFrame:
    m = mentions.keyed(X.mentions(spark, sf)).filter("description <> ''")
    return m.groupBy("key").agg(F.min_by("description", F.struct(-F.length("description"), "pos")).alias("description"))


@query(f"{COUNTED}, {X.ENTITIES}, taken AS (SELECT {X.norm_sql('label')} AS key FROM entities) SELECT pos, name FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY pos) AS r FROM keyed WHERE key NOT IN (SELECT key FROM taken)) WHERE r = 1")
def dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    taken = X.entities(spark).select(T.norm_name("label").alias("norm_name"))
    return mentions.first_by_name(X.mentions(spark, sf), taken).select("pos", "name")


@query(f"{COUNTED}, {X.ENTITIES} SELECT DISTINCT key FROM keyed WHERE key NOT IN (SELECT {X.norm_sql('label')} FROM entities)")
def anti_curated(spark: SparkSession, sf: str) -> DataFrame:
    taken = X.entities(spark).select(T.norm_name("label").alias("key"))
    return mentions.keyed(X.mentions(spark, sf)).join(taken, "key", "left_anti").select("key").distinct()


TAKEN = ["The", "The_2", "The_4", "To_2", "Of_3", "In_x", "In_02", "La"]


@query(f"""{COUNTED}, parts AS (SELECT pos, name, array_to_string(list_transform(regexp_extract_all(name, '[A-Za-z0-9]+'), lambda p: upper(p[1]) || p[2:]), '') AS j FROM keyed),
based AS (SELECT pos, name, substr(CASE WHEN j = '' THEN 'Entity' WHEN regexp_matches(j, '^[0-9]') THEN 'E' || j ELSE j END, 1, 60) AS base FROM parts),
nth AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY pos) AS n FROM based),
most AS (SELECT base, max(n) + {len(TAKEN)} AS k FROM nth GROUP BY base),
free AS (SELECT base, row_number() OVER (PARTITION BY base ORDER BY i) AS n, local FROM (SELECT base, i, CASE WHEN i = 1 THEN base ELSE base || '_' || i END AS local FROM (SELECT base, unnest(range(1, k + 1)) AS i FROM most)) WHERE local NOT IN (SELECT unnest({TAKEN})))
SELECT pos, local FROM nth JOIN free USING (base, n)""")
def mint_names(spark: SparkSession, sf: str) -> DataFrame:
    taken = spark.createDataFrame([(t,) for t in TAKEN], "local string")
    return mentions.mint(mentions.keyed(X.mentions(spark, sf)), taken).select("pos", "local")


TYPES = ", ".join(f"('{k}', '{c}', '{t}', {w}, {f"'{d}'" if d else 'NULL'})" for k, (c, t, w, d) in ontology.TYPE_MAP.items())


@query(f"""WITH {X.CHUNKS}, {X.MENTIONS}, tm(t, class, tag, in_world, defined) AS (VALUES {TYPES})
SELECT pos, class, tag, in_world, defined, CASE WHEN class = 'rpg:Tag' THEN 'skos:prefLabel' ELSE 'rpg:name' END AS label FROM mentions JOIN tm ON t = CASE WHEN type IN (SELECT t FROM tm) THEN type ELSE 'Concept' END""")
def type_map(spark: SparkSession, sf: str) -> DataFrame:
    return ontology.with_class(X.mentions(spark, sf)).select("pos", "class", "tag", "in_world", "defined", ontology.label_predicate().alias("label"))


@query(f"{COUNTED} SELECT coalesce(type, '') AS type, count(*) AS n FROM keyed GROUP BY 1")
def mention_types(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.type_counts(mentions.keyed(X.mentions(spark, sf)).withColumn("type", F.coalesce("type", F.lit(""))))


@query(f"""{COUNTED}, n AS (SELECT key AS name, count(*) AS mentions FROM keyed GROUP BY key)
SELECT name, printf('shard_%03d', (row_number() OVER (ORDER BY mentions DESC, name) - 1) // 5) AS shard FROM n""")
def describe_groups(spark: SparkSession, sf: str) -> DataFrame:
    n = mentions.keyed(X.mentions(spark, sf)).groupBy(F.col("key").alias("name")).agg(F.count("*").alias("mentions"))
    return mentions.describe_groups(n, 5).select("name", "shard")


# Ontology.

TRIPLES = f"""{X.ENTITIES}, triples AS (
SELECT iri AS s, '{ontology.RDF}type' AS p, unnest(types) AS o FROM entities UNION ALL SELECT iri, '{ontology.RPG}name', label FROM entities WHERE label <> ''
UNION ALL SELECT iri, '{ontology.SKOS}altLabel', unnest(aliases) FROM entities UNION ALL SELECT iri, '{ontology.DC}description', summary FROM entities WHERE summary <> '')"""


@query(f"WITH {TRIPLES} SELECT s, p, o FROM triples")
def triples_from_entities(spark: SparkSession, sf: str) -> DataFrame:
    return ontology.entity_triples(X.entities(spark), X.NAMES).select("s", "p", "o")


@query(f"""WITH {X.ENTITIES}, al AS (SELECT iri, list_sort(list(DISTINCT a)) AS aliases FROM (SELECT iri, unnest(list_append(aliases, label)) AS a FROM entities) GROUP BY iri)
SELECT iri, array_to_string(list_sort(types), ' ') AS types, label, array_to_string(al.aliases, '|') AS aliases, summary FROM entities JOIN al USING (iri)""")
def entity_index(spark: SparkSession, sf: str) -> DataFrame:
    """From flat entities to triples and back."""
    t = ontology.entity_triples(X.entities(spark), X.NAMES)
    e = ontology.entity_index(t, X.NAMES)
    return e.select("iri", F.array_join("types", " ").alias("types"), "label", F.array_join("aliases", "|").alias("aliases"), "summary")


_VOCABULARY = ", ".join(
    f"('{X.BASE}{term}', '{p}', '{o}')"
    for term, label, comment in (
        ("Sourcebook", "Sourcebook", "A pack of documents, which adds entities and links to the graph."),
        ("attestedIn", "attested in", "From an entity to a pack whose documents mention it."),
        ("definedIn", "defined in", "From an entity to a pack that it was extracted from."),
        ("bookSlug", "book slug", "The name of a pack in file paths."),
    )
    for p, o in ((ontology.RDF + "type", ontology.RDFS + "Class" if term == "Sourcebook" else ontology.RDF + "Property"), (ontology.RDFS + "label", label), (ontology.RDFS + "comment", comment))
)


@query(f"""WITH {X.LINKED}, {X.ATTESTED}, {X.PACKS}, b AS (SELECT slug, '{X.BASE}Book_' || upper(slug[1]) || slug[2:] AS s FROM packs),
e AS (SELECT iri, 'attestedIn' AS slot, unnest(attestedIn) AS slug FROM attested UNION ALL SELECT iri, 'definedIn', unnest(definedIn) FROM attested)
SELECT s, '{ontology.RDF}type' AS p, unnest(['{X.BASE}Sourcebook', '{ontology.SCHEMA}Book']) AS o FROM b
UNION ALL SELECT s, '{ontology.DC}title', title FROM b JOIN packs USING (slug) UNION ALL SELECT s, '{X.BASE}bookSlug', slug FROM b
UNION ALL SELECT b.s, '{ontology.DC}requires', c.s FROM (SELECT slug, unnest(requires) AS r FROM packs) JOIN b USING (slug) JOIN b c ON c.slug = r
UNION ALL SELECT iri, '{X.BASE}' || slot, s FROM e JOIN b USING (slug)
UNION ALL SELECT * FROM (VALUES {_VOCABULARY}) AS v(s, p, o)""")
def provenance_edges(spark: SparkSession, sf: str) -> DataFrame:
    return ontology.provenance_triples(X.packs(spark, sf), X.attested(spark, sf), X.NAMES).select("s", "p", "o")
