"""Integrity checks, each a table (check, severity, key, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.operators import packs as P


def _rows(df: DataFrame, check: str, severity: str, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), key.cast("string").alias("key"), detail.alias("detail"))


def unknown_requires(packs: DataFrame) -> DataFrame:
    known = packs.select(F.col("slug").alias("requires"))
    bad = P.edges(packs).join(known, "requires", "left_anti")
    return _rows(bad, "unknown_requires", "error", F.col("pack"), F.concat(F.lit("requires unknown pack "), "requires"))


def cycles(packs: DataFrame) -> DataFrame:
    """By pack: how many edges close a cycle depends on where one starts."""
    return _rows(P.cyclic(packs), "cycle", "error", F.col("pack"), F.lit("is on a cycle of requires"))


def unknown_packs(entities: DataFrame, packs: DataFrame) -> DataFrame:
    slots = [entities.select("iri", F.lit(s).alias("slot"), F.explode(s).alias("slug")) for s in ("attestedIn", "definedIn")]
    bad = slots[0].unionByName(slots[1]).join(packs.select("slug"), "slug", "left_anti")
    return _rows(bad, "unknown_pack", "error", F.col("iri"), F.concat("slot", F.lit(" names unknown pack "), "slug"))


def dangling(chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """references: how many references from chunks name no entity, counted each."""
    return chunks.select(F.explode("entities").alias("iri")).join(entities.select("iri"), "iri", "left_anti").agg(F.count("*").alias("references"))


def dangling_references(chunks: DataFrame, entities: DataFrame) -> DataFrame:
    n = dangling(chunks, entities).filter(F.col("references") > 0)
    return _rows(n, "dangling", "error", F.lit(""), F.concat(F.col("references").cast("string"), F.lit(" dangling chunk-to-entity references")))


def missing_chunks(packs: DataFrame, chunks: DataFrame) -> DataFrame:
    bad = packs.join(chunks.select(F.col("doc").alias("slug")).distinct(), "slug", "left_anti")
    return _rows(bad, "missing_chunks", "warning", F.col("slug"), F.lit("has no chunks"))


def defined_not_attested(entities: DataFrame) -> DataFrame:
    """Entities that no pack which defines them attests."""
    none = F.array().cast("array<string>")
    bad = entities.filter(~P.is_spine() & ~F.arrays_overlap(F.coalesce("definedIn", none), F.coalesce("attestedIn", none)))
    return _rows(bad, "defined_not_attested", "warning", F.col("iri"), F.lit("defined in a pack that does not attest it"))


def bad_vectors(vectors: DataFrame, dim: int, normalised: bool = True) -> DataFrame:
    """Vectors of another dimension, with null components, or of a norm other than 1 or 0."""
    n = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    why = F.when(F.col("vector").isNull() | (F.size("vector") != dim), "wrong dimension").when(F.exists("vector", lambda x: x.isNull()), "null component")
    if normalised:
        why = why.when((F.abs(n - 1) > 1e-3) & (n > 0), "not normalised")
    return _rows(vectors.withColumn("why", why).filter("why is not null"), "bad_vector", "error", F.col("id"), F.col("why"))


def missing_fields(df: DataFrame, name: str, required: list[str], key: str) -> DataFrame:
    """A row for each required field that is null."""
    missing = F.filter(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in required)), lambda c: c.isNotNull())
    bad = df.select(F.col(key).alias("key"), F.explode(missing).alias("field"))
    return _rows(bad, "missing_field", "error", F.col("key"), F.concat(F.lit(f"{name}."), "field"))


def duplicate_ids(df: DataFrame, name: str, key: str) -> DataFrame:
    bad = df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    return _rows(bad, "duplicate_id", "error", F.col(key), F.concat(F.lit(f"{name}: "), F.col("n").cast("string"), F.lit(" rows")))


def bad_values(df: DataFrame, name: str, column: str, allowed: list[str], key: str) -> DataFrame:
    bad = df.filter(~F.col(column).isin(allowed))
    return _rows(bad, "bad_value", "error", F.col(key), F.concat(F.lit(f"{name}.{column}: "), column))


def validate(packs: DataFrame, entities: DataFrame, chunks: DataFrame) -> DataFrame:
    """All checks of a dataset."""
    ids = [duplicate_ids(df, name, key) for df, name, key in ((chunks, "chunk", "id"), (entities, "entity", "iri")) if key in df.columns]
    parts = [*ids, unknown_requires(packs), cycles(packs), unknown_packs(entities, packs), dangling_references(chunks, entities), missing_chunks(packs, chunks), defined_not_attested(entities)]
    return reduce(DataFrame.unionByName, parts)


def status(report: DataFrame) -> DataFrame:
    """ok, errors, warnings."""
    errors = F.count_if(F.col("severity") == "error")
    return report.agg((errors == 0).alias("ok"), errors.alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
