"""Packs and their dependencies: closure, roots, cycles, resolution, composed views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.sources.staging import reliable


def registry(spark: SparkSession, path: str) -> DataFrame:
    """slug, title, path, requires from a JSON object keyed by slug."""
    raw = spark.read.text(path, wholetext=True)
    kind = "map<string,struct<title:string,path:string,requires:array<string>>>"
    rows = raw.select(F.explode(F.from_json("value", kind)).alias("slug", "m"))
    return rows.select("slug", "m.title", "m.path", F.coalesce("m.requires", F.array().cast("array<string>")).alias("requires"))


def edges(packs: DataFrame) -> DataFrame:
    """pack, requires."""
    return packs.select(F.col("slug").alias("pack"), F.explode("requires").alias("requires"))


def reachable(deps: DataFrame, start: DataFrame, most_rounds: int = 1000) -> DataFrame:
    """origin, pack: what each start (origin, pack) reaches over (pack, requires), itself included; cycles are safe.

    A frontier of new pairs only is joined in each round, and written to reliable checkpoints, so that shared parts of
    a dense graph are walked once."""
    seen = reliable(start.select("origin", "pack").distinct())
    new = seen
    for _ in range(most_rounds):
        step = new.join(deps, "pack").select("origin", F.col("requires").alias("pack")).distinct()
        new = reliable(step.join(seen, ["origin", "pack"], "left_anti"))
        if new.isEmpty():
            return seen
        seen = seen.union(new)
    raise RuntimeError("closure did not end")


def closure(packs: DataFrame, selected: DataFrame) -> DataFrame:
    """pack: the selected packs (slug) and all they require; unknown packs stay in."""
    start = selected.select(F.lit("").alias("origin"), F.col("slug").alias("pack"))
    return reachable(edges(packs), start).select("pack").distinct()


def dependants(packs: DataFrame, removed: DataFrame) -> DataFrame:
    """pack: what must go with the removed packs (slug).  An extension: the closure over reversed edges."""
    back = edges(packs).select(F.col("requires").alias("pack"), F.col("pack").alias("requires"))
    return reachable(back, removed.select(F.lit("").alias("origin"), F.col("slug").alias("pack"))).select("pack").distinct()


def roots(packs: DataFrame) -> DataFrame:
    return packs.filter(F.size(F.coalesce("requires", F.array().cast("array<string>"))) == 0).select("slug")


def cyclic(packs: DataFrame) -> DataFrame:
    """pack: those that reach themselves."""
    e = edges(packs)
    start = e.select(F.col("pack").alias("origin"), F.col("requires").alias("pack"))
    return reachable(e, start).filter("origin = pack").select("pack").distinct()


def resolve(packs: DataFrame, tokens: DataFrame) -> DataFrame:
    """token, slug, status (exact, unique, none, ambiguous): slug is null unless found.  Blank tokens are skipped."""
    t = tokens.select(F.trim("token").alias("token")).filter("token <> ''").distinct()
    # A registry is one file and tokens are what a user typed, so slugs travel as an array in one row: no join at all.
    slugs = packs.agg(F.array_sort(F.collect_set("slug")).alias("slugs"))
    held = t.crossJoin(F.broadcast(slugs)).withColumn("hits", F.filter("slugs", lambda s: s.contains(F.col("token"))))
    hit = held.select("token", F.explode_outer("hits").alias("slug"))
    g = hit.groupBy("token").agg(F.count("slug").alias("n"), F.max(F.when(F.col("slug") == F.col("token"), F.col("slug"))).alias("same"), F.max("slug").alias("any"))
    status = F.when(F.col("same").isNotNull(), "exact").when(F.col("n") == 1, "unique").when(F.col("n") == 0, "none").otherwise("ambiguous")
    return g.select("token", F.when(F.col("same").isNotNull(), F.col("same")).when(F.col("n") == 1, F.col("any")).alias("slug"), status.alias("status"))


def selection(packs: DataFrame, tokens: DataFrame | None) -> DataFrame:
    """slug of the packs that tokens select, all without any; raises on unknown or ambiguous ones."""
    if tokens is None:
        return packs.select("slug")
    found = resolve(packs, tokens)
    if bad := found.filter("slug is null").limit(5).collect():
        raise ValueError("; ".join(f"pack {r['token']!r}: {r['status']}" for r in bad))
    return found.select("slug").distinct()


def is_spine(defined: str = "definedIn"):
    """Whether an entity has no defining pack."""
    return F.coalesce(F.size(defined), F.lit(0)) == 0


def entities_in_scope(entities: DataFrame, scope: DataFrame) -> DataFrame:
    """Spine entities, and those that a pack in scope (pack) attests."""
    attested = entities.select("iri", F.explode("attestedIn").alias("pack")).join(scope.distinct(), "pack", "left_semi").select("iri").distinct()
    book = entities.filter(~is_spine()).join(attested, "iri", "left_semi")
    return entities.filter(is_spine()).unionByName(book)


def compose(packs: DataFrame, entities: DataFrame, sources: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """One row: selected, closure, added_by_requires, chunk_files, vector_files, counts."""
    chosen = selection(packs, tokens)
    scope = closure(packs, chosen)
    listed = lambda df, c, name: df.agg(F.array_sort(F.collect_set(c)).alias(name))  # noqa: E731  as many as packs
    chunks = scope.join(sources.select(F.col("slug").alias("pack"), "chunks"), "pack", "left").agg(F.count("*").cast("int").alias("packs"), F.coalesce(F.sum("chunks"), F.lit(0)).cast("int").alias("chunks"))
    inside = entities_in_scope(entities, scope).agg(F.count("*").cast("int").alias("entities_in_scope"), F.count_if(~is_spine()).cast("int").alias("book_entities_in_scope"))
    total = entities.agg(F.count_if(is_spine()).cast("int").alias("spine_entities"), F.count_if(~is_spine()).cast("int").alias("book_entities_total"))
    one = listed(chosen, "slug", "selected").crossJoin(listed(scope, "pack", "closure")).crossJoin(chunks).crossJoin(inside).crossJoin(total)  # a row each
    files = lambda folder: F.transform("closure", lambda p: F.concat(F.lit(folder), p, F.lit(".jsonl")))
    counts = F.struct("packs", "chunks", "entities_in_scope", "spine_entities", "book_entities_in_scope", "book_entities_total")
    return one.select("selected", "closure", F.array_except("closure", "selected").alias("added_by_requires"), files("content/chunks/").alias("chunk_files"), files("embeddings/vectors/").alias("vector_files"), counts.alias("counts"))
