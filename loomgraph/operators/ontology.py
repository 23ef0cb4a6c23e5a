"""RDF in both directions: triples to a flat entity index, entities and provenance to triples and Turtle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions import text as T

# Public vocabularies.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
DC = "http://purl.org/dc/terms/"
SCHEMA = "https://schema.org/"
RPG = "https://rpg-schema.org/ns/rpg#"

#: Predicates of a label, and of a summary, in order of preference.
LABELS = (RPG + "name", SCHEMA + "name", RDFS + "label", SKOS + "prefLabel")
ALIASES = (SKOS + "altLabel", *LABELS)
SUMMARIES = (DC + "description", SCHEMA + "description", RDFS + "comment")

# Extracted type -> (class, local name of its grouping tag, in the world?, predicate of its rule set).
TYPE_MAP = {
    "Character": ("rpg:Character", "CharacterTag", True, None),
    "House": ("rpg:Faction", "HermeticHouse", True, None),
    "Tribunal": ("rpg:Faction", "Tribunal", True, None),
    "Covenant": ("rpg:Faction", "Covenant", True, None),
    "Faction": ("rpg:Faction", "FactionTag", True, None),
    "Spell": ("rpg:Spell", "NamedSpell", False, "rpg:capabilityDefinedInRuleSet"),
    "Item": ("rpg:Item", "MagicItem", False, "rpg:itemDefinedInRuleSet"),
    "Creature": ("rpg:Creature", "Creature", True, None),
    "Virtue": ("rpg:Tag", "Virtue", False, None),
    "Flaw": ("rpg:Tag", "Flaw", False, None),
    "Ability": ("rpg:Proficiency", "HermeticAbility", False, "rpg:capabilityDefinedInRuleSet"),
    "Art": ("rpg:Proficiency", "HermeticArt", False, "rpg:capabilityDefinedInRuleSet"),
    "Concept": ("rpg:Tag", "HermeticConcept", False, None),
    "Realm": ("rpg:Tag", "Realm", False, None),
    "Place": ("schema:Place", "Place", True, None),
    "CharacterType": ("rpg:Tag", "CharacterType", False, None),
}
DEFAULT_TYPE = "Concept"
# Tags whose label does not follow from their name.
TAG_LABELS = {"Realm": "Realm of Power"}


@dataclass(frozen=True)
class Names:
    """The dataset's own namespace: its base IRI and prefix, its world and its rule set."""

    base: str
    prefix: str = "kg"
    world: str = "World"
    rule_set: str = "RuleSet"
    book_class: str = "Sourcebook"


def objects(triples: DataFrame, predicate: str, name: str = "o") -> DataFrame:
    """s and the objects of one predicate."""
    return triples.filter(F.col("p") == predicate).select("s", F.col("o").alias(name))


def subjects(triples: DataFrame, predicate: str, value: str) -> DataFrame:
    return triples.filter((F.col("p") == predicate) & (F.col("o") == value)).select("s").distinct()


def categories(triples: DataFrame) -> DataFrame:
    """iri: grouping nodes, which are not matched in texts."""
    return triples.filter(F.col("p").isin(RPG + "hasTag", RPG + "ruleSetType")).select(F.col("o").alias("iri")).distinct()


def _preferred(predicates: tuple[str, ...]) -> Column:
    """The least object of the first predicate that has any."""
    place = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(predicates))):
        place = F.when(F.col("p") == p, i).otherwise(place)
    return F.min(F.when(place.isNotNull(), F.struct(place.alias("place"), F.col("o").alias("o"))))["o"]


def entity_index(triples: DataFrame, names: Names) -> DataFrame:
    """iri, types, label, aliases, summary, tags of the entities of the dataset: subjects below the base with a type and
    a label, but for books and vocabulary terms.  Of several objects of one predicate the least is taken."""
    own = triples.filter(F.col("s").startswith(names.base))
    own = own.join(subjects(triples, RDF + "type", names.base + names.book_class), "s", "left_anti")
    tag_label = triples.groupBy("s").agg(_preferred((SKOS + "prefLabel", RDFS + "label")).alias("tag")).filter("tag is not null").withColumnRenamed("s", "o")
    tags = own.filter(F.col("p") == RPG + "hasTag").select("s", "o").join(tag_label, "o").groupBy("s").agg(F.array_sort(F.collect_list("tag")).alias("tags"))
    e = own.groupBy("s").agg(
        F.array_sort(F.collect_set(F.when(F.col("p") == RDF + "type", F.col("o")))).alias("types"),
        _preferred(LABELS).alias("label"),
        F.array_sort(F.collect_set(F.when(F.col("p").isin(*ALIASES), F.col("o")))).alias("aliases"),
        _preferred(SUMMARIES).alias("summary"),
    )
    e = e.filter((F.size("types") > 0) & ~F.arrays_overlap("types", F.array(F.lit(RDF + "Property"), F.lit(RDFS + "Class"))) & F.col("label").isNotNull())
    x = e.join(tags, "s", "left")
    return x.select(F.col("s").alias("iri"), "types", "label", "aliases", F.coalesce("summary", F.lit("")).alias("summary"), F.coalesce("tags", F.array().cast("array<string>")).alias("tags"))


def taken_names(triples: DataFrame, names: Names) -> DataFrame:
    """norm_name of everything the curated graph names."""
    return triples.filter(F.col("s").startswith(names.base) & F.col("p").isin(*ALIASES)).select(T.norm_name("o").alias("norm_name")).distinct()


def taken_locals(triples: DataFrame, names: Names) -> DataFrame:
    return triples.select(T.local_in("s", names.base).alias("local")).filter("local is not null").distinct()


def type_map(spark: SparkSession) -> DataFrame:
    """type, class, tag, in_world, defined."""
    return spark.createDataFrame([(k, *v) for k, v in TYPE_MAP.items()], "type string, class string, tag string, in_world boolean, defined string")


def with_class(entities: DataFrame) -> DataFrame:
    """entities (type) plus class, tag, in_world, defined; unknown types count as concepts."""
    known = type_map(entities.sparkSession)
    t = F.when(F.col("type").isin(*TYPE_MAP), F.col("type")).otherwise(F.lit(DEFAULT_TYPE))
    return entities.withColumn("__t", t).join(F.broadcast(known.withColumnRenamed("type", "__t")), "__t").drop("__t")


def label_predicate() -> Column:
    return F.when(F.col("class") == "rpg:Tag", F.lit("skos:prefLabel")).otherwise(F.lit("rpg:name"))


def entity_blocks(entities: DataFrame, names: Names, max_aliases: int = 8) -> DataFrame:
    """pos, iri, block: a Turtle statement per extracted entity (local, name, type, description, aliases)."""
    p = names.prefix
    x = with_class(entities)
    distinct = F.array_distinct(F.filter(F.transform(F.coalesce("aliases", F.array().cast("array<string>")), T.strip), lambda a: (a != "") & (T.norm_name(a) != T.norm_name("name"))))
    some = F.slice(distinct, 1, max_aliases)
    lines = F.concat(
        F.array(
            F.concat(F.lit(f"{p}:"), "local", F.lit(" a "), "class", F.lit(" ;")),
            F.concat(F.lit("    "), label_predicate(), F.lit(" "), T.literal(T.strip("name")), F.lit(" ;")),
        ),
        F.when(T.strip(F.coalesce("description", F.lit(""))) != "", F.array(F.concat(F.lit("    dc:description "), T.literal("description"), F.lit(" ;")))).otherwise(F.array().cast("array<string>")),
        F.when(F.size(some) > 0, F.array(F.concat(F.lit("    skos:altLabel "), F.array_join(F.transform(some, lambda a: T.literal(a)), ", "), F.lit(" ;")))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("in_world"), F.array(F.lit(f"    rpg:inWorld {p}:{names.world} ;"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("defined").isNotNull(), F.array(F.concat(F.lit("    "), "defined", F.lit(f" {p}:{names.rule_set} ;")))).otherwise(F.array().cast("array<string>")),
        F.array(F.concat(F.lit(f"    rpg:hasTag {p}:"), "tag", F.lit(" ."))),
    )
    return x.select("pos", F.concat(F.lit(names.base), "local").alias("iri"), F.array_join(lines, "\n").alias("block"))


def new_tags(entities: DataFrame, taken: DataFrame, names: Names) -> DataFrame:
    """tag, block: grouping tags that extracted entities need and the graph (taken: local) lacks."""
    need = with_class(entities).select("tag").distinct().join(taken.select(F.col("local").alias("tag")), "tag", "left_anti")
    label = F.trim(F.regexp_replace(F.regexp_replace("tag", "Tag$", ""), "([a-z])([A-Z])", "$1 $2"))
    for tag, fixed in TAG_LABELS.items():
        label = F.when(F.col("tag") == tag, F.lit(fixed)).otherwise(label)
    return need.select("tag", F.concat(F.lit(f"{names.prefix}:"), "tag", F.lit(" a rpg:Tag ; skos:prefLabel "), T.literal(label), F.lit(" .")).alias("block"))


def entity_triples(entities: DataFrame, names: Names) -> DataFrame:
    """s, p, o, o_is_iri of flat entities (iri, types, label, aliases, summary): the index turned back into a graph."""
    one = lambda p, c, iri=False: entities.filter(F.col(c).isNotNull() & (F.col(c) != "")).select(F.col("iri").alias("s"), F.lit(p).alias("p"), F.col(c).alias("o"), F.lit(iri).alias("o_is_iri"))
    many = lambda p, c, iri=False: entities.select(F.col("iri").alias("s"), F.lit(p).alias("p"), F.explode(c).alias("o"), F.lit(iri).alias("o_is_iri"))
    return many(RDF + "type", "types", True).unionByName(one(RPG + "name", "label")).unionByName(many(SKOS + "altLabel", "aliases")).unionByName(one(DC + "description", "summary"))


# Terms of the provenance vocabulary, by kind, with their labels.
TERMS = {"attestedIn": "attested in", "definedIn": "defined in", "bookSlug": "book slug"}


def vocabulary(spark: SparkSession, names: Names) -> DataFrame:
    """s, p, o, o_is_iri of the class and the properties that provenance uses."""
    what = {
        names.book_class: "A pack of documents, which adds entities and links to the graph.",
        "attestedIn": "From an entity to a pack whose documents mention it.",
        "definedIn": "From an entity to a pack that it was extracted from.",
        "bookSlug": "The name of a pack in file paths.",
    }
    rows = []
    for term, comment in what.items():
        s = names.base + term
        rows += [(s, RDF + "type", RDFS + "Class" if term == names.book_class else RDF + "Property", True), (s, RDFS + "label", TERMS.get(term, term), False), (s, RDFS + "comment", comment, False)]
    return spark.createDataFrame(rows, "s string, p string, o string, o_is_iri boolean")


def provenance_triples(packs: DataFrame, entities: DataFrame, names: Names) -> DataFrame:
    """s, p, o, o_is_iri: the vocabulary, book nodes with title, slug and requires, and entity edges; unknown packs are left out."""
    iri = lambda c: F.concat(F.lit(names.base), T.pack_local(c))
    lit = lambda p, o: packs.select(iri("slug").alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(False).alias("o_is_iri"))
    ref = lambda p, o: packs.select(iri("slug").alias("s"), F.lit(p).alias("p"), F.lit(o).alias("o"), F.lit(True).alias("o_is_iri"))
    known = packs.select(F.col("slug").alias("other"))
    needs = packs.select("slug", F.explode("requires").alias("other")).join(known, "other", "left_semi")
    out = vocabulary(packs.sparkSession, names).unionByName(ref(RDF + "type", names.base + names.book_class)).unionByName(ref(RDF + "type", SCHEMA + "Book"))
    out = out.unionByName(lit(DC + "title", F.coalesce(F.nullif("title", F.lit("")), "slug"))).unionByName(lit(names.base + "bookSlug", F.col("slug")))
    out = out.unionByName(needs.select(iri("slug").alias("s"), F.lit(DC + "requires").alias("p"), iri("other").alias("o"), F.lit(True).alias("o_is_iri")))
    for slot in ("attestedIn", "definedIn"):
        e = entities.filter(F.col("iri").startswith(names.base)).select("iri", F.explode(slot).alias("other")).join(known, "other", "left_semi")
        out = out.unionByName(e.select(F.col("iri").alias("s"), F.lit(names.base + slot).alias("p"), iri("other").alias("o"), F.lit(True).alias("o_is_iri")))
    return out


def turtle(triples: DataFrame) -> DataFrame:
    """s, block: one Turtle statement per subject, predicates and objects in order."""
    value = F.when(F.col("o_is_iri"), F.concat(F.lit("<"), "o", F.lit(">"))).otherwise(T.literal("o", fold=False))
    po = triples.groupBy("s", "p").agg(F.array_join(F.array_sort(F.collect_set(value)), ", ").alias("os"))
    body = po.groupBy("s").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p", "os"))), lambda x: F.concat(F.lit("<"), x["p"], F.lit("> "), x["os"])), " ;\n    ").alias("body"))
    return body.select("s", F.concat(F.lit("<"), "s", F.lit("> "), "body", F.lit(" .")).alias("block"))


def replace_block(graph: str, marker: str, block: str) -> str:
    """The graph with the block between the marker and its end replaced, or with a new one at its end; blocks of other steps, before
    and behind, stay.  An older block without an end mark reaches to the end of the graph."""
    close = f"{marker} (end)"
    head, found, tail = graph.partition(f"{marker}\n")
    if not found and graph.rstrip().endswith(marker):
        head, tail = graph.rstrip()[: -len(marker)], ""
    tail = tail.partition(f"{close}\n")[2] if found and f"{close}\n" in tail else ""
    whole = f"{head.rstrip()}\n\n{marker}\n\n{block.strip()}\n\n{close}\n"
    return whole.lstrip("\n") + (f"\n{tail.strip()}\n" if tail.strip() else "")


def write_block(spark: SparkSession, path: str, marker: str, block: str) -> int:
    """Puts a generated block in a Turtle file, in place of its earlier version; the whole has to parse before it is written.  Returns its triples."""
    from loomgraph.sources import records, turtle

    whole = replace_block(records.get_text(spark, path) or "", marker, block)
    n = len(turtle.parse(whole))
    records.put_text(spark, path, whole)
    return n
