"""How the registered queries read the engine's inputs from the driver's tables, and the same in SQL.

Documents are the corpus, their sources the packs (src<n> requires src<n div 2>, the root is src0), rows of embeddings
the vectors of the first chunk of the document with their number; headings come from conversations.  The entity
vocabulary is a constant that queries and SQL share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.operators import chunking, linking
from loomgraph.operators.ontology import Names
from loomgraph.sources.staging import reliable

BASE = "https://example.org/kg/"
NAMES = Names(BASE)

#: iri, types, label, aliases, summary, tags, definedIn.
VOCABULARY = [
    ("OfThe", ["Concept"], "of the", ["of the", "Of The"], "A pair of words.", ["Pair"], ["src1", "src3"]),
    ("OnThe", ["Concept", "Tag"], "on the", ["on the"], "", ["Pair", "Pair"], []),
    ("TheOn", ["Tag"], "the on", ["the on"], "Overlaps the others.", [], ["src2"]),
    ("The", ["Word"], "The", ["the", "The"], "An article.", ["Article"], []),
    ("And", ["Word"], "And", ["And"], "", [], ["src99"]),
    ("Thin", ["Place"], "thin", ["thin", "of the"], "Shares a name.", ["Region"], ["src4"]),
    ("Or", ["Word"], "or", ["or"], "Too short to link.", [], []),
]
QUERY = "the thin and the on of the and"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entities(spark: SparkSession) -> DataFrame:
    rows = [(BASE + i, [BASE + "type#" + t for t in ts], label, aliases, summary, tags, d) for i, ts, label, aliases, summary, tags, d in VOCABULARY]
    return spark.createDataFrame(rows, "iri string, types array<string>, label string, aliases array<string>, summary string, tags array<string>, definedIn array<string>")


def spread(df: DataFrame) -> DataFrame:
    """df, dealt to all cores where one split holds more than twice a core's share of its rows, or where there are fewer splits than cores;
    other tables are not shuffled.

    A row group is read by one task whatever the number of splits, so that rows are counted, from the footers alone, without a column.  Rows
    are dealt by their place, as a deal in turn would sort whole texts first."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    if splits >= cores:
        held = df.groupBy(F.spark_partition_id()).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).head()
        if (held["most"] or 0) * cores <= 2 * (held["all"] or 0):
            return df
    return df.withColumn("__at", F.monotonically_increasing_id()).repartition(max(cores, splits), "__at").drop("__at")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("slug"), "source", "text")


def chunks(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    return chunking.chunk(documents(spark, sf_dir), "slug", keep=keep)


def linked(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    return linking.with_entities(chunks(spark, sf_dir, keep), linking.alias_keys(entities(spark)))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source, entities of each chunk, without its text; written, as several parts of a query count them."""
    return reliable(linked(spark, sf_dir, ["source"]).select("source", "entities"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One for the first chunk of each document whose number an embedding has."""
    return table(spark, sf_dir, "embeddings").select(F.format_string("d%d::0000", "vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))


def query_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    return list(table(spark, sf_dir, "embeddings").filter("vec_id = 0").select(F.col("embedding").cast("array<double>")).head()[0])


def packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slug, title, requires."""
    s = table(spark, sf_dir, "documents").select(F.col("source").alias("slug")).filter("slug is not null").distinct()
    n = F.substring("slug", 4, 10).cast("int")
    needs = F.when(n > 0, F.array(F.concat(F.lit("src"), (F.floor(n / 2)).cast("string")))).otherwise(F.array().cast("array<string>"))
    return s.select("slug", F.concat(F.lit("Pack "), "slug").alias("title"), needs.alias("requires"))


def attested(spark: SparkSession, sf_dir: str, linked_chunks: DataFrame | None = None) -> DataFrame:
    """The vocabulary with attestedIn: the sources whose chunks (source, entities) link to it."""
    c = linked(spark, sf_dir, ["source"]) if linked_chunks is None else linked_chunks
    hits = c.select("source", F.explode("entities").alias("iri"))
    found = hits.groupBy("iri").agg(F.array_sort(F.collect_set("source")).alias("attestedIn"))
    return entities(spark).join(found, "iri", "left").withColumn("attestedIn", F.coalesce("attestedIn", F.array().cast("array<string>")))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, other: the first words of benchmark items, each with the next in order, which every third lists as an alias."""
    first = table(spark, sf_dir, "benchmark").select(F.get(F.split("text", " "), F.lit(0)).alias("key")).filter(F.col("key").rlike("^[A-Za-z]{3,}$")).distinct()
    order = W.orderBy("key")  # a few hundred
    return first.select("key", F.when(F.row_number().over(order) % 3 == 0, F.lead("key").over(order)).alias("other"))


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pos, name, type, aliases, description, evidence: the hits of the linker in all chunks of the whole texts."""
    known = names(spark, sf_dir)
    keys = known.select(F.lit("word").alias("kind"), "key", F.col("key").alias("iri"))
    hits = linking.hits_by_pattern(chunks(spark, sf_dir).select("id", "text"), keys).select("id", "key").distinct().join(F.broadcast(known), "key")
    kind = F.get(F.array(F.lit("Place"), F.lit("Spell"), F.lit(None), F.lit("Oddity")), F.length("key") % 4)
    aliases = F.array_compact(F.array(F.upper("key"), F.concat(F.lit(" "), "key", F.lit(" one ")), "other"))
    doc = F.substring_index("id", "::", 1)
    return hits.select(F.concat("id", F.lit("/"), "key").alias("pos"), F.col("key").alias("name"), kind.alias("type"), aliases.alias("aliases"), F.concat(F.lit("Named  "), "key", F.lit(" in "), doc).alias("description"), F.array("id").alias("evidence"))


# The same in SQL.


def _list(xs: list[str]) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]::VARCHAR[]"


ENTITIES = "entities(iri, types, label, aliases, summary, tags, definedIn) AS (VALUES " + ", ".join(f"('{BASE}{i}', {_list([BASE + 'type#' + t for t in ts])}, '{label}', {_list(a)}, '{s}', {_list(tags)}, {_list(d)})" for i, ts, label, a, s, tags, d in VOCABULARY) + ")"


def clean_sql(t: str) -> str:
    t = rf"regexp_replace(regexp_replace(regexp_replace({t}, '\[([^\]]+)\]\([^)]*\)', '\1', 'g'), '<[^>]+>', ' ', 'g'), '&[a-z]+;', ' ', 'g')"
    return rf"trim(regexp_replace(regexp_replace(replace({t}, chr(160), ' '), '^\s*>\s?', ''), '[ \t]+', ' ', 'g'), E' \t\n\r')"


def norm_sql(t: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(regexp_replace(lower({t}), '^the\s+', ''), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g'))"


CHUNKS = rf"""docs AS (SELECT 'd' || doc_id AS doc, source, string_split(trim(regexp_replace({clean_sql("text")}, '\s+', ' ', 'g')), ' ') AS ws FROM documents WHERE text IS NOT NULL),
wins AS (SELECT doc, source, ws, unnest(CASE WHEN len(ws) <= 246 THEN [0] ELSE range(0, (ceil((len(ws) - 246) / 210.0) * 210)::BIGINT + 1, 210) END) AS start FROM docs WHERE ws <> ['']),
cut AS (SELECT doc, source, start, ws[start + 1 : start + 246] AS w FROM wins),
chunks AS (SELECT doc, source, (row_number() OVER (PARTITION BY doc ORDER BY start) - 1)::INT AS seq, array_to_string(w, ' ') AS text, len(w)::INT AS n_words FROM cut WHERE len(w) >= 12),
ch AS (SELECT printf('%s::%04d', doc, seq) AS id, * FROM chunks)"""

KEYS = rf"""keys AS (SELECT DISTINCT CASE WHEN contains(a, ' ') THEN 'words' ELSE 'word' END AS kind, CASE WHEN contains(a, ' ') THEN lower(a) ELSE a END AS key, iri
  FROM (SELECT iri, trim(unnest(aliases)) AS a FROM entities) WHERE length(a) >= 3)"""


def _alternatives(many: bool) -> str:
    keys = {a.lower() if many else a for v in VOCABULARY for a in v[3] if (" " in a) == many and len(a) >= 3}
    return "|".join(sorted(keys, key=lambda k: (-len(k), k)))


#: A letter beyond ASCII counts as x, as word boundaries here know ASCII only.
HITS = rf"""plain AS (SELECT id, doc, source, regexp_replace(text, '[^\x00-\x7F]', 'x', 'g') AS t FROM ch),
hits AS (SELECT id, doc, source, 'words' AS kind, unnest(regexp_extract_all(lower(t), '\b(?:{_alternatives(True)})\b')) AS key FROM plain
  UNION ALL SELECT id, doc, source, 'word', unnest(regexp_extract_all(t, '\b(?:{_alternatives(False)})\b')) FROM plain),
links AS (SELECT DISTINCT id, doc, source, iri FROM hits JOIN keys USING (kind, key)),
linked AS (SELECT ch.*, coalesce(e, []) AS entities FROM ch LEFT JOIN (SELECT id, list_sort(list(iri)) AS e FROM links GROUP BY id) USING (id))"""

LINKED = f"{ENTITIES}, {KEYS}, {CHUNKS}, {HITS}"

VECTORS = "vectors AS (SELECT printf('d%d::0000', vec_id) AS id, embedding::DOUBLE[] AS vector FROM embeddings), q AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = 0)"

PACKS = "packs AS (SELECT DISTINCT source AS slug, 'Pack ' || source AS title, CASE WHEN substr(source, 4)::INT > 0 THEN ['src' || (substr(source, 4)::INT // 2)] ELSE []::VARCHAR[] END AS requires FROM documents WHERE source IS NOT NULL)"

ATTESTED = "attested AS (SELECT entities.*, coalesce(a, []) AS attestedIn FROM entities LEFT JOIN (SELECT iri, list_sort(list(DISTINCT source)) AS a FROM links GROUP BY iri) USING (iri))"

#: To be used behind CHUNKS or LINKED, as ``plain`` stands in the latter.
MENTIONS = rf"""firsts AS (SELECT DISTINCT split_part(text, ' ', 1) AS key FROM benchmark WHERE regexp_matches(split_part(text, ' ', 1), '^[A-Za-z]{{3,}}$')),
listed AS (SELECT key, CASE WHEN row_number() OVER (ORDER BY key) % 3 = 0 THEN lead(key) OVER (ORDER BY key) END AS other FROM firsts),
words AS (SELECT DISTINCT id, unnest(regexp_extract_all(regexp_replace(text, '[^\x00-\x7F]', 'x', 'g'), '\w+')) AS key FROM ch),
mentions AS (SELECT id || '/' || key AS pos, key AS name, ['Place', 'Spell', NULL, 'Oddity'][length(key) % 4 + 1] AS type,
  list_filter([upper(key), ' ' || key || ' one ', other], lambda a: a IS NOT NULL) AS aliases, 'Named  ' || key || ' in ' || split_part(id, '::', 1) AS description, [id] AS evidence FROM words JOIN listed USING (key))"""

KEYED = rf"""keyed AS (SELECT * EXCLUDE (name), trim(name) AS name, {norm_sql("name")} AS key FROM mentions WHERE regexp_matches(name, '[A-Za-z]') AND length({norm_sql("name")}) >= 2)"""
