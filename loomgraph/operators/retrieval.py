"""Exact vector search, expansion through shared entities, and context assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.functions import text as T
from loomgraph.functions import vectors as V

K, EXPAND = 5, 3


def scores(vectors: DataFrame, query: list[float]) -> DataFrame:
    """id, score: in the scan of the vectors, so that no vector is shuffled."""
    q = F.array(*(F.lit(float(x)) for x in query))
    return vectors.select("id", V.dot("vector", q).alias("score"))


def top_k(chunks: DataFrame, vectors: DataFrame, query: list[float], k: int = K) -> DataFrame:
    """rank, id, score of the k best chunks that have a vector; ties go to the greater id."""
    if k < 0:
        raise ValueError("k must not be negative")
    best = scores(vectors, query).join(chunks.select("id"), "id").orderBy(F.desc("score"), F.desc("id")).limit(k)
    return best.select(F.row_number().over(W.orderBy(F.desc("score"), F.desc("id"))).alias("rank"), "id", "score")


#: Hits up to which they are broadcast.
HITS = 10_000


def _hint(df: DataFrame) -> DataFrame:
    """df, broadcast if it has few rows; of ids or IRIs only, so that rows bound the bytes."""
    return F.broadcast(df) if df.limit(HITS + 1).count() <= HITS else df


def seeds(chunks: DataFrame, hits: DataFrame) -> DataFrame:
    """iri: distinct entities of the hits (id)."""
    return chunks.join(_hint(hits.select("id")), "id", "left_semi").select(F.explode("entities").alias("iri")).distinct()


def expand(chunks: DataFrame, vectors: DataFrame, query: list[float], hits: DataFrame, m: int = EXPAND) -> DataFrame:
    """rank, id, overlap, score of the m best other chunks that share entities with the hits, by overlap, score and id
    (all descending); a chunk without a vector scores 0."""
    some = seeds(chunks, hits).agg(F.collect_set("iri").alias("seeds"))
    x = chunks.join(_hint(hits.select("id")), "id", "left_anti").select("id", "entities").crossJoin(F.broadcast(some))  # one row
    x = x.select("id", F.size(F.array_intersect("entities", "seeds")).alias("overlap")).filter("overlap > 0")
    x = x.join(scores(vectors, query), "id", "left").select("id", "overlap", F.coalesce("score", F.lit(0.0)).alias("score"))
    order = (F.desc("overlap"), F.desc("score"), F.desc("id"))
    best = x.orderBy(*order).limit(max(0, m))
    return best.select(F.row_number().over(W.orderBy(*order)).alias("rank"), "id", "overlap", "score")


def facts(chunks: DataFrame, entities: DataFrame, chosen: DataFrame) -> DataFrame:
    """iri, fact of the known entities of the chosen chunks (id)."""
    iris = seeds(chunks, chosen)
    return entities.join(_hint(iris), "iri").select("iri", T.fact_line("label", "tags", "summary").alias("fact"))


def passages(chunks: DataFrame, entities: DataFrame, hits: DataFrame, more: DataFrame) -> DataFrame:
    """kind, rank, id, doc, score, breadcrumb, labels, snippet, text: hits in order of rank, then what expansion found.

    text is the whole chunk on one line, for the model; snippet is what a console shows of it."""
    chosen = hits.select(F.lit("top").alias("kind"), "rank", "id", "score").unionByName(more.select(F.lit("expanded").alias("kind"), "rank", "id", "score"))
    x = chunks.join(_hint(chosen), "id")
    names = x.select("id", F.posexplode("entities").alias("pos", "iri")).join(entities.select("iri", "label"), "iri")
    names = names.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "label"))), lambda s: s["label"]).alias("names"))
    x = x.join(names, "id", "left")
    labels = F.when(F.size("names") > 0, F.array_join("names", ", ")).otherwise(F.lit("—"))
    return x.select("kind", "rank", "id", "doc", "score", T.breadcrumb("heading_path").alias("breadcrumb"), labels.alias("labels"), T.snippet("text").alias("snippet"), T.collapse("text").alias("text"))


def context(found: DataFrame, known: DataFrame) -> DataFrame:
    """part, nth, line: what a model is given, facts in order of their IRIs, then whole passages in order."""
    a = known.select(F.lit("fact").alias("part"), F.row_number().over(W.orderBy("iri")).alias("nth"), F.concat(F.lit("- "), "fact").alias("line"))
    order = F.when(F.col("kind") == "top", 1).otherwise(2)
    b = found.select(F.lit("passage").alias("part"), F.row_number().over(W.orderBy(order, "rank")).alias("nth"), F.concat(F.lit("["), "id", F.lit("] "), "text").alias("line"))
    return a.unionByName(b)


def report(found: DataFrame) -> DataFrame:
    """part, rank, lines: what a console shows of each passage: how it was found, its score and document, breadcrumb, entities and snippet."""
    tag = F.when(F.col("kind") == "top", F.lit("sim")).otherwise(F.lit("rel"))
    lines = F.array(F.format_string("[%s %.3f] %s", tag, F.col("score"), F.col("doc")), F.col("breadcrumb"), F.concat(F.lit("entities: "), "labels"), F.concat("snippet", F.lit("…")))
    return found.select(F.col("kind").alias("part"), "rank", F.array_join(lines, "\n").alias("lines"))
