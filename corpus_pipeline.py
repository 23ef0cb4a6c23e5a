"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes what the one before it kept, as (spark, docs, sf_dir), and returns documents with the same
columns; the last returns the packed pieces.  Between stages documents are written as Parquet to the shared
folder and read again; the tables that a stage made for itself go when the next one is called, unless its documents still
read them.

Defined cases: those of the operators; further, a document that line dedup empties is a copy and goes; of a group
of near duplicates the row with the least doc_id stays, rows without one coming last; rows that share a doc_id are
documents each; where a doc_id does not tell rows apart, or is null, they get numbers beyond the largest for the mix, and
rows without a doc_id keep them.  An empty table passes through all stages.

No SQL can express the classifier or the packing plan, so ORACLE_SQL is None and a test holds the stages
against brute-force versions of them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import jaccard_join, line_dedup, mixing, packing, quality
from loomgraph.llm.common import Stage, small, table
from loomgraph.llm.queries import WORD_BPE

#: Near duplicates: words of a shingle, and similarity in percent.
SHINGLE, PERCENT = 5, 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the co-trained classifier rejects."""
    return quality.score(docs, table(spark, sf_dir, "labels")).filter("keep").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without later copies of repeated line runs; texts that lose all their lines go."""
    out = line_dedup.dedup_lines(docs).filter("n_removed = 0 or text <> ''")
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def own_ids(docs: DataFrame, stage: Stage) -> DataFrame:
    """docs with a doc_id of its own for each row, and __id, the one it came with: rows that share a doc_id or have none
    are numbered beyond the largest."""
    first = max(0, docs.agg(F.max("doc_id")).head()[0] or 0) + 1
    nth = F.col("__key")["nth"]
    keyed = line_dedup.with_keys(docs, stage).withColumn("__id", F.col("doc_id").cast("string"))  # pandas keeps nulls in strings
    return keyed.withColumn("doc_id", F.when(nth < 0, F.col("doc_id")).otherwise(F.lit(first) + nth)).drop("__key")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least number of each group of near duplicates."""
    stage = Stage(spark, "near")
    own = own_ids(docs, stage)
    classes = jaccard_join.jaccard_classes(own.drop("__id"), SHINGLE, PERCENT)
    gone = stage.write(classes.filter("doc_id <> component_id").select("doc_id"), "gone")
    out = own.join(small(gone), "doc_id", "left_anti")
    return out.withColumn("doc_id", F.col("__id").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as their source's target takes."""
    stage = Stage(spark, "mix")
    own = own_ids(docs, stage)
    out = mixing.apply_mix(own, mixing.mix(own))
    return out.withColumn("doc_id", F.coalesce(F.col("__id").cast("long"), "doc_id")).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece with its sequence and its place there."""
    return packing.pack(docs, WORD_BPE)


_held: list[Stage] = []


def _tidy(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage that first removes the tables of those before it, whose results have been written by now."""

    @wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()
        for s in [s for s in _held if not any(s.root.split(":", 1)[-1] in path for path in read)]:
            s.remove()
            _held.remove(s)
        first = len(Stage.made)
        out = step(spark, docs, sf_dir)
        _held.extend(Stage.made[first:])
        return out

    return run


STAGES = [
    ("quality classifier", _tidy(keep_good)),
    ("line dedup", _tidy(drop_repeated_lines)),
    ("near duplicates", _tidy(drop_near_duplicates)),
    ("source mix", _tidy(mix_sources)),
    ("best-fit packing", _tidy(pack_sequences)),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage, docs = Stage(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage.write(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
