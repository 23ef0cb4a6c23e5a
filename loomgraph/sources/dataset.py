"""A dataset in its folder: found through its manifest, read, built and described."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators import chunking, embedding, linking, packs, provenance
from loomgraph.sources import records as R
from loomgraph.sources import schemas as S
from loomgraph.sources.staging import reliable


@dataclass
class Dataset:
    """Paths come from the manifest at the root; they become arguments of Spark's readers."""

    spark: SparkSession
    root: str
    manifest: dict = field(default_factory=dict)

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> Dataset:
        text = spark.read.text(f"{root}/manifest.json", wholetext=True).head()[0]
        return cls(spark, root, json.loads(text))

    def chunks(self) -> DataFrame:
        return R.ndjson(self.spark, f"{self.root}/{self.manifest['content']['chunks_glob']}", S.CHUNK)

    def vectors(self) -> DataFrame:
        return R.ndjson(self.spark, f"{self.root}/{self.manifest['embeddings']['vectors_glob']}", S.EMBEDDING)

    def entities(self) -> DataFrame:
        return R.ndjson(self.spark, f"{self.root}/{self.manifest['ontology']['entity_index']}", S.ENTITY)

    def packs(self) -> DataFrame:
        return packs.registry(self.spark, f"{self.root}/{self.manifest['content']['books']}")

    def sources(self) -> DataFrame:
        return R.keyed(self.spark, f"{self.root}/{self.manifest['content']['sources']}", S.SOURCE, missing_ok=True)


@dataclass
class Built:
    chunks: DataFrame
    entities: DataFrame
    vectors: DataFrame
    #: The ids of the vectors where they are known without embedding a text: each text gets one vector.
    vector_ids: DataFrame | None = None


def build(documents: DataFrame, entities: DataFrame, categories: DataFrame, mentions: DataFrame, provider: str = "hashed", options: dict | None = None, tokens: int = 320, overlap: int = 48, min_words: int = 12, cache: DataFrame | None = None) -> Built:
    """Chunks with entities, entities with provenance, and vectors of documents (slug, text).

    With a cache (id, text_hash, provider, model, dim, vector) only chunks whose text and model are new are embedded."""
    options = options or {}
    chunks = chunking.chunk(documents, "slug", tokens=tokens, overlap=overlap, min_words=min_words)
    linked = linking.with_entities(chunks, linking.alias_keys(entities, categories))
    linked = reliable(linked)
    stamped = provenance.stamp(entities, linked, provenance.evidence(mentions))
    keyed = linked.withColumns({"text_hash": F.sha2("text", 256), "provider": F.lit(provider), "model": F.lit(options.get("model", "")), "dim": F.lit(int(options.get("dim") or embedding.DIM))})
    if cache is None:
        vectors, ids = embedding.embed(linked.select("id", "text"), provider, options), linked.select("id")
    else:
        old, need = embedding.split_by_cache(keyed, cache)
        ids = old.select("id").unionByName(need.select("id"))
        vectors = old.select("id", "vector").unionByName(embedding.embed(need.select("id", "text"), provider, options))
    return Built(linked, stamped, vectors, ids)


#: The parts of a manifest that come from its layout alone.
# Keys and constants of the public manifest schema.
LAYOUT = {
    "ontology": {"format": "text/turtle", "graph": "ontology/graph.ttl", "entity_index": "ontology/entities.jsonl", "prefixes": "ontology/prefixes.json"},
    "content": {"format": "application/x-ndjson", "chunks_glob": "content/chunks/*/*.json", "sources": "content/sources.json", "books": "content/books.json"},
    "embeddings": {"config": "embeddings/config.json", "vectors_glob": "embeddings/vectors/*/*.json", "metric": "cosine", "normalized": True, "alignment": "by_id"},
    "schema": {name: f"schema/{name}.schema.json" for name in ("chunk", "embedding", "entity", "manifest")},
    "composition": {"model": "packs", "version": "1", "unit": "document set", "registry": "content/books.json", "dependency": "dc:requires"},
}
#: What a manifest must hold.
NEEDED = ["dataset.id", "dataset.name", "dataset.version", "ontology.graph", "ontology.entity_index", "ontology.base_iri", "content.chunks_glob", "embeddings.vectors_glob", "embeddings.dim", "embeddings.metric"]


@dataclass
class About:
    """What a manifest says that no table holds.  ``spec`` is the key and the version by which a service knows the format."""

    id: str
    name: str
    version: str
    base_iri: str
    spec: tuple[str, str] = ("spec", "0.1")
    license: str | None = None
    source_repo: str | None = None
    builder: str = "loomgraph"
    aligns_with: list[dict] = field(default_factory=list)
    scope: str = "a scope is the closure of the chosen packs over their requires; entities no pack defines belong to every scope"


def describe(built: Built, registry: DataFrame | None, about: About, provider: str, model: str, dim: int, tokens: int = 320, overlap: int = 48) -> dict:
    """The manifest as a dictionary: the layout, the numbers of one aggregate row for each table, and what ``about`` says."""
    found = {k: v | {} for k, v in LAYOUT.items() if k != "composition" or registry is not None}
    found[about.spec[0]] = about.spec[1]
    told = {"id": about.id, "name": about.name, "version": about.version, "license": about.license, "source_repo": about.source_repo, "builder": about.builder}
    found["dataset"] = {k: v for k, v in told.items() if v is not None} | {"built_at": datetime.now(UTC).isoformat(timespec="seconds")}
    types = {r["type"]: r["n"] for r in provenance.type_counts(built.entities).orderBy("type").collect()}
    found["ontology"] |= {"base_iri": about.base_iri, "aligns_with": about.aligns_with, "counts": {"entities": built.entities.count(), "by_type": types}}
    c = built.chunks.agg(F.count("*").alias("chunks"), F.count_distinct("doc").alias("documents")).head()
    found["content"] |= {"chunking": {"strategy": "heading+window", "target_tokens": tokens, "overlap_tokens": overlap, "token_heuristic": "words*1.3"}, "counts": c.asDict()}
    found["embeddings"] |= {"provider": provider, "model": model, "dim": dim, "counts": {"vectors": (built.vectors if built.vector_ids is None else built.vector_ids).count()}}
    if registry is not None:
        core = sorted(r["slug"] for r in packs.roots(registry).collect())
        found["composition"] |= {"core": core, "scope": about.scope, "counts": {"packs": registry.count()}}
    if missing := absent(found):
        raise ValueError(f"the manifest lacks {', '.join(missing)}")
    return found


def absent(manifest: dict) -> list[str]:
    """The required fields that a manifest lacks."""
    out = []
    for name in NEEDED:
        part, key = name.split(".")
        if manifest.get(part, {}).get(key) in (None, ""):
            out.append(name)
    return out


def save(spark: SparkSession, root: str, built: Built, manifest: dict, registry: DataFrame | None = None, sources: DataFrame | None = None) -> None:
    """Writes a dataset in the layout of its manifest; Dataset.open finds it there."""
    R.write_ndjson(built.chunks.withColumn("part", F.pmod(F.hash("doc"), F.lit(16))), f"{root}/content/chunks", "part")
    R.write_ndjson(built.vectors.withColumn("part", F.pmod(F.hash("id"), F.lit(16))), f"{root}/embeddings/vectors", "part")
    R.write_ndjson(built.entities, f"{root}/ontology/entities.jsonl")
    if registry is not None:
        R.write_keyed(registry, "slug", f"{root}/content/books.json")
    if sources is not None:
        R.write_keyed(sources, "slug", f"{root}/content/sources.json")
    R.put_text(spark, f"{root}/manifest.json", json.dumps(manifest, indent=2, ensure_ascii=False))
