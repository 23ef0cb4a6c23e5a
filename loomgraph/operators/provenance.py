"""Where entities come from, and statistics of a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import text as T


def attested(chunks: DataFrame) -> DataFrame:
    """iri, attestedIn: the documents that mention each entity, sorted."""
    return chunks.select("doc", F.explode("entities").alias("iri")).groupBy("iri").agg(F.array_sort(F.collect_set("doc")).alias("attestedIn"))


def evidence(mentions: DataFrame) -> DataFrame:
    """norm_name, doc from extracted entities (name, evidence: chunk ids)."""
    m = mentions.select(T.strip("name").alias("name"), F.explode("evidence").alias("chunk")).filter("name <> ''")
    return m.select(T.norm_name("name").alias("norm_name"), T.doc_of_chunk("chunk").alias("doc")).filter("doc is not null").distinct()


def defined(entities: DataFrame, found: DataFrame, docs: DataFrame) -> DataFrame:
    """iri, definedIn: documents with evidence for any name of an entity, of those built (doc)."""
    names = entities.select("iri", F.explode(F.array_union(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))
    keys = names.select("iri", T.norm_name("name").alias("norm_name")).distinct()
    hits = keys.join(found, "norm_name").join(docs.select("doc").distinct(), "doc", "left_semi")
    return hits.groupBy("iri").agg(F.array_sort(F.collect_set("doc")).alias("definedIn"))


def stamp(entities: DataFrame, chunks: DataFrame, found: DataFrame) -> DataFrame:
    """entities plus attestedIn and definedIn."""
    none = F.array().cast("array<string>")
    x = entities.join(attested(chunks), "iri", "left").join(defined(entities, found, chunks.select("doc")), "iri", "left")
    return x.withColumns({"attestedIn": F.coalesce("attestedIn", none), "definedIn": F.coalesce("definedIn", none)})


def type_counts(entities: DataFrame) -> DataFrame:
    """type, n: an entity of several types counts under each."""
    return entities.select(F.explode("types").alias("iri")).groupBy(T.local_name("iri").alias("type")).agg(F.count("*").alias("n"))


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """doc, chunks, linked."""
    return chunks.groupBy("doc").agg(F.count("*").alias("chunks"), F.count_if(F.size("entities") > 0).alias("linked"))


def source_stats(files: DataFrame, chunks: DataFrame) -> DataFrame:
    """slug, title, path, status, sha256, bytes, chunks of binary files (slug, rel, content)."""
    counted = chunks.groupBy(F.col("doc").alias("slug")).agg(F.count("*").cast("int").alias("chunks"))
    body = F.col("content").cast("string")
    x = files.select("slug", T.title_of(body, "slug").alias("title"), F.col("rel").alias("path"), T.status_of("rel").alias("status"), F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("bytes"))
    return x.join(counted, "slug", "left").withColumn("chunks", F.coalesce("chunks", F.lit(0)))


def totals(documents: DataFrame, chunks: DataFrame, vectors: DataFrame, entities: DataFrame, packs: DataFrame) -> DataFrame:
    """One row of the numbers that a manifest reports."""
    n = lambda df, name: df.agg(F.count("*").alias(name))
    e = entities.agg(F.count("*").alias("entities"), F.count_if(F.size("attestedIn") > 0).alias("attested"), F.count_if(F.size("definedIn") > 0).alias("defined"))
    return n(documents, "documents").crossJoin(n(chunks, "chunks")).crossJoin(n(vectors, "vectors")).crossJoin(e).crossJoin(n(packs, "packs"))  # a row each
