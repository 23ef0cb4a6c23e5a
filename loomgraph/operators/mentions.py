"""Raw entity mentions to canonical entities.

Mentions are rows (pos, name, type, aliases, description, evidence); ``pos`` is their order in the input, which
decides ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.operators.components import components
from loomgraph.sources.staging import reliable

MAX_ALIAS, MAX_ALIASES, MAX_DESCRIPTION, MAX_EVIDENCE = 60, 8, 500, 5
DEFAULT_TYPE = "Concept"


def keyed(mentions: DataFrame) -> DataFrame:
    """Usable mentions with their key: a name with an ASCII letter, of two characters at least after normalisation."""
    m = mentions.withColumn("name", T.strip(F.coalesce("name", F.lit(""))))
    return m.filter(F.col("name").rlike("[A-Za-z]")).withColumn("key", T.norm_name("name")).filter(F.length("key") >= 2)


def _aliases(m: DataFrame) -> DataFrame:
    """key, alias."""
    return m.select("key", F.explode("aliases").alias("alias")).filter((F.col("alias") != "") & (F.length("alias") <= MAX_ALIAS)).select("key", T.strip("alias").alias("alias")).distinct()


def merge_edges(m: DataFrame) -> DataFrame:
    """a, b: keys of which one lists the other as an alias (of four characters at least)."""
    named = _aliases(m).select("key", T.norm_name("alias").alias("other")).filter("length(other) >= 4 and other <> key").distinct()
    return named.join(m.select(F.col("key").alias("other")).distinct(), "other", "left_semi").select(F.col("key").alias("a"), F.col("other").alias("b"))


def mode(m: DataFrame, by: str, value: str, order: Column) -> DataFrame:
    """by, value: the commonest value of each group; of equals the one first in order."""
    n = m.filter(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(by, value).agg(F.count("*").alias("__n"), F.min(order).alias("__first"))
    return n.groupBy(by).agg(F.min_by(value, F.struct(-F.col("__n"), "__first")).alias(value))


def canonical(mentions: DataFrame) -> DataFrame:
    """name, type, aliases, description, evidence, mentions: one row per entity.

    Groups by normalised name are merged along alias edges; ties go by each group's first mention, then by the
    mention within the group.  Usable mentions are written once; their fields are then counted together, one aggregate by (entity, field,
    value) and one by entity."""
    m = reliable(keyed(mentions))
    parts = components(merge_edges(m)).select(F.col("node").alias("key"), "component")
    groups = m.groupBy("key").agg(F.min("pos").alias("__group")).join(parts, "key", "left").withColumn("entity", F.coalesce("component", "key")).drop("component")
    m = m.join(groups, "key")
    none = F.array().cast("array<string>")
    value = lambda f, v: F.struct(F.lit(f).alias("field"), v.alias("value"))
    aliases = F.transform(F.filter(F.coalesce("aliases", none), lambda a: (a != "") & (F.length(a) <= MAX_ALIAS)), lambda a: value("alias", T.strip(a)))
    fields = F.concat(F.array(value("name", F.col("name")), value("type", F.nullif("type", F.lit(""))), value("description", T.flatten(F.coalesce("description", F.lit(""))))), aliases, F.transform(F.coalesce("evidence", none), lambda e: value("evidence", e)))
    rows = m.select("entity", F.struct("__group", "pos").alias("at"), F.explode(fields).alias("f")).filter("f.value is not null and not (f.field = 'description' and f.value = '')")
    n = rows.groupBy("entity", "f.field", "f.value").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    of = lambda f, c: F.when(F.col("field") == f, c)
    most = lambda f: F.min_by(of(f, F.col("value")), of(f, F.struct(-F.col("n"), "first")))
    longest = F.min_by(of("description", F.col("value")), of("description", F.struct(-F.length("value"), "first")))
    total = F.sum(of("name", F.col("n")))
    x = n.groupBy("entity").agg(
        total.alias("mentions"), most("name").alias("name"), most("type").alias("type"), F.substring(longest, 1, MAX_DESCRIPTION).alias("description"),
        F.collect_set(of("alias", F.col("value"))).alias("aliases"), F.collect_set(of("evidence", F.col("value"))).alias("evidence"),
    )
    others = F.filter(F.array_sort("aliases"), lambda a: T.norm_name(a) != T.norm_name("name"))
    return x.select("name", F.coalesce("type", F.lit(DEFAULT_TYPE)).alias("type"), F.slice(others, 1, MAX_ALIASES).alias("aliases"), F.coalesce("description", F.lit("")).alias("description"), F.slice(F.array_sort("evidence"), 1, MAX_EVIDENCE).alias("evidence"), "mentions")


def first_seen(mentions: DataFrame, aliases: int = 12, descriptions: int = 6, evidence: int = 8) -> DataFrame:
    """The plainer aggregation before descriptions are written: first-seen name, commonest type, and the first few
    aliases (the name is one), descriptions and pieces of evidence in order of appearance.

    Usable mentions are written once, as five aggregates read them."""
    m = keyed(mentions).withColumn("aliases", F.array_append(F.coalesce("aliases", F.array().cast("array<string>")), F.col("name")))
    m = reliable(m.select("key", "pos", "name", "type", "aliases", "description", "evidence"))

    def firsts(column: str, n: int, name: str, keep: Column | None = None, distinct: bool = True) -> DataFrame:
        x = m.select("key", "pos", F.posexplode(column).alias("i", "v")) if column != "description" else m.select("key", "pos", F.lit(0).alias("i"), F.col("description").alias("v"))
        x = x.filter((F.col("v") != "") & (keep if keep is not None else F.lit(True)))
        if distinct:
            x = x.groupBy("key", "v").agg(F.min(F.struct("pos", "i")).alias("at"))
        else:
            x = x.select("key", "v", F.struct("pos", "i").alias("at"))
        x = x.withColumn("r", F.row_number().over(W.partitionBy("key").orderBy("at"))).filter(F.col("r") <= n)
        return x.groupBy("key").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "v"))), lambda s: s["v"]).alias(name))

    base = m.groupBy("key").agg(F.min_by("name", "pos").alias("name"), F.count("*").alias("mentions"))
    parts = [mode(m, "key", "type", F.col("pos")), firsts("aliases", aliases, "aliases", F.length("v") <= MAX_ALIAS), firsts("description", descriptions, "candidate_descriptions", distinct=False), firsts("evidence", evidence, "evidence")]
    for p in parts:
        base = base.join(p, "key", "left")
    none = F.array().cast("array<string>")
    return base.select("name", F.coalesce("type", F.lit(DEFAULT_TYPE)).alias("type"), *(F.coalesce(c, none).alias(c) for c in ("aliases", "candidate_descriptions", "evidence")), "mentions")


def describe_groups(entities: DataFrame, size: int = 25) -> DataFrame:
    """entities plus shard: groups of so many in order of mentions (descending) and name, for a describer.

    The order is total, so the numbering is a range sort with partition offsets."""
    from loomgraph.operators.ordering import numbered

    x = numbered(entities, [F.desc("mentions"), F.collate("name", "UNICODE"), F.col("name")], "__n")
    return x.withColumn("shard", F.format_string("shard_%03d", F.floor(F.col("__n") / size).cast("int"))).drop("__n")


def first_by_name(mentions: DataFrame, taken: DataFrame) -> DataFrame:
    """The first mention of each normalised name that is not taken (norm_name)."""
    m = keyed(mentions).join(taken.select(F.col("norm_name").alias("key")).distinct(), "key", "left_anti")
    return m.withColumn("__r", F.row_number().over(W.partitionBy("key").orderBy("pos"))).filter("__r = 1").drop("__r", "key")


def type_counts(entities: DataFrame) -> DataFrame:
    return entities.groupBy("type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "type")


def written(reports: DataFrame) -> DataFrame:
    """shards, records: what describers reported (written); null reports do not count."""
    return reports.agg(F.count_if(F.col("path").isNotNull()).alias("shards"), F.coalesce(F.sum("written"), F.lit(0)).alias("records"))


def mint(entities: DataFrame, taken: DataFrame) -> DataFrame:
    """entities (pos, name) plus local: unique local names, clear of the taken ones (local).

    The n-th entity of a base name gets the n-th free place in the series base, base_2, base_3, ...; a base has letters
    and digits only, so series do not meet, and the places that taken names hold are known beforehand."""
    e = entities.withColumn("__base", T.camel_local("name")).withColumn("__n", F.row_number().over(W.partitionBy("__base").orderBy("pos")))
    numbered = F.regexp_extract("local", "^([A-Za-z0-9]+)_([1-9][0-9]*)$", 2)
    held = taken.select(F.when(numbered != "", F.regexp_extract("local", "^([A-Za-z0-9]+)_", 1)).otherwise(F.col("local")).alias("__b"), F.when(numbered != "", F.expr("try_cast(regexp_extract(local, '_([1-9][0-9]*)$', 1) as long)")).otherwise(F.lit(1)).alias("at"), numbered.alias("number"))
    held = held.filter("number = '' or at >= 2").groupBy("__b").agg(F.array_sort(F.collect_set("at")).alias("held"))
    x = e.join(held, F.col("__base") == F.col("__b"), "left")
    place = F.aggregate(F.coalesce("held", F.array().cast("array<bigint>")), F.col("__n").cast("long"), lambda n, t: F.when(t <= n, n + 1).otherwise(n))
    local = F.when(place == 1, F.col("__base")).otherwise(F.concat("__base", F.lit("_"), place.cast("string")))
    return x.withColumn("local", local).drop("__base", "__b", "__n", "held")
