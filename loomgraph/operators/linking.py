"""Dictionary entity linking.

Aliases of several words match without regard to case, single words exactly.  Either class is one leftmost,
longest-first, non-overlapping pass over a text with word boundaries at both ends; the two passes are
independent, so that a word may also link inside a longer match."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.text import strip

#: Aliases up to which a class is one regular expression; beyond it, or above, n-grams are joined instead.
PATTERN_KEYS = 5_000
BROADCAST_BYTES = 16 << 20


def alias_keys(entities: DataFrame, exclude: DataFrame | None = None, min_length: int = 3) -> DataFrame:
    """kind (words or word), key, iri: the alias table; ``exclude`` (iri) keeps classifier nodes out."""
    e = entities.join(exclude.select("iri").distinct(), "iri", "left_anti") if exclude is not None else entities
    a = e.select("iri", F.explode("aliases").alias("alias")).withColumn("alias", strip("alias")).filter(F.length("alias") >= min_length)
    many = F.col("alias").contains(" ")
    return a.select(F.when(many, F.lit("words")).otherwise(F.lit("word")).alias("kind"), F.when(many, F.lower("alias")).otherwise(F.col("alias")).alias("key"), "iri").distinct()


def _escape(key: str) -> str:
    return "".join(c if c.isalnum() or c == "_" else "\\" + c for c in key)


def pattern(keys: list[str], ignore_case: bool) -> str:
    """One alternation, longest first."""
    body = "|".join(_escape(k) for k in sorted(keys, key=lambda k: (-len(k), k)))
    return rf"(?{'i' if ignore_case else ''}U)\b(?:{body})\b"


def _hit(kind: str):
    return lambda h: F.struct(F.lit(kind).alias("kind"), (F.lower(h) if kind == "words" else h).alias("key"))


def _runs(text: Column | str) -> Column:
    """Words and what lies between them, in turn.  Cut, not extracted: Spark copies the whole text for every match that it extracts."""
    return F.split(text, r"(?U)(?<=\w)(?=\W)|(?<=\W)(?=\w)")


def _grams(kind: str, n: int, word: bool) -> Column:
    """The grams of n of the runs __r that begin with a word, or with none.

    A key matches between word boundaries, so it covers whole runs; one that begins or ends with other characters than a word's needs
    a word before or behind it.  Runs are words and others in turn, so that every second one begins a gram."""
    first = F.when(F.get("__r", F.lit(0)).rlike(r"(?U)^\w"), 0 if word else 1).otherwise(1 if word else 2)
    last = F.size("__r") - n - (0 if word == (n % 2 == 1) else 1)
    key = lambda i: F.get("__r", i) if n == 1 else F.array_join(F.slice("__r", i + 1, n), "")
    gram = lambda i: F.struct(i.alias("i"), F.lit(n).alias("n"), F.lit(kind).alias("kind"), (F.lower(key(i)) if kind == "words" else key(i)).alias("key"))
    return F.transform(F.when(first <= last, F.sequence(first, last, F.lit(2))).otherwise(F.array().cast("array<int>")), gram)


def _none(texts: DataFrame) -> DataFrame:
    return texts.select("id", F.lit("word").alias("kind"), F.lit("").alias("key")).limit(0)


def _found(keys: DataFrame) -> Column | None:
    """The hits of a text as an array (kind, key), by one alternation for each kind."""
    parts: list[Column] = []
    rows = keys.select("kind", "key").distinct().collect()
    for kind in ("words", "word"):
        if not (ks := [r["key"] for r in rows if r["kind"] == kind]):
            continue
        if kind == "word" and all(re.fullmatch("[A-Za-z0-9_]+", k) for k in ks):
            # Such a key matches a whole run of word characters, so that runs are looked up.
            parts.append(F.transform(F.filter(F.split("text", r"(?U)\W+"), lambda w: w.isin(ks)), _hit(kind)))
        else:
            parts.append(F.transform(F.regexp_extract_all("text", F.lit(pattern(ks, kind == "words")), F.lit(0)), _hit(kind)))
    return F.concat(*parts) if parts else None


def fits_pattern(keys: DataFrame) -> bool:
    return keys.limit(PATTERN_KEYS + 1).count() <= PATTERN_KEYS


def hits_by_pattern(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """id, kind, key of every hit, for a vocabulary small enough for a pattern."""
    if not fits_pattern(keys):
        return hits_by_grams(texts, keys)
    found = _found(keys)
    return _none(texts) if found is None else texts.select("id", F.explode(found).alias("h")).select("id", "h.*")


def hits_by_grams(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The same by a join: grams of word and non-word runs that are keys, then a greedy pass over the matches."""
    table = keys.select("kind", "key").distinct()
    shapes = table.select("kind", F.size(_runs("key")).alias("n"), F.col("key").rlike(r"(?U)^\w").alias("word")).distinct().collect()
    if not shapes:
        return _none(texts)
    x = texts.select("id", _runs("text").alias("__r"))
    grams = [_grams(*shape) for shape in sorted(tuple(s) for s in shapes)]
    g = x.select("id", F.explode(F.concat(*grams)).alias("g")).select("id", "g.*")
    m = g.join(_hint(table.select("kind", "key")), ["kind", "key"])
    # Leftmost, then longest; the next may begin where the last one ended.
    m = m.groupBy("id", "kind").agg(F.sort_array(F.collect_list(F.struct("i", (-F.col("n")).alias("n"), "key"))).alias("m"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("keys"))
    took = F.aggregate("m", start, lambda a, h: F.when(h["i"] >= a["at"], F.struct((h["i"] - h["n"]).alias("at"), F.concat(a["keys"], F.array(h["key"])).alias("keys"))).otherwise(a))
    return m.select("id", "kind", F.explode(took["keys"]).alias("key"))


def _hint(keys: DataFrame) -> DataFrame:
    """keys, broadcast if they are few and short."""
    n = keys.agg(F.sum(F.octet_length("key") + 200)).head()[0] or 0
    return F.broadcast(keys) if n <= BROADCAST_BYTES else keys


def link(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """id, entities: sorted IRIs of every row of ``texts`` (id, text) that links to any."""
    hits = hits_by_pattern(texts, keys).distinct()
    return hits.join(_hint(keys), ["kind", "key"]).groupBy("id").agg(F.array_sort(F.collect_set("iri")).alias("entities"))


def with_entities(chunks: DataFrame, keys: DataFrame) -> DataFrame:
    """chunks plus entities, empty where nothing links.

    A small vocabulary is looked up in each row; a larger one is joined, and its links are joined back by id."""
    none = F.array().cast("array<string>")
    if not fits_pattern(keys):
        linked = link(chunks.select("id", "text"), keys)
        return chunks.join(linked, "id", "left").withColumn("entities", F.coalesce("entities", none))
    found = _found(keys)
    if found is None:
        return chunks.withColumn("entities", none)
    name = lambda h: F.concat(h["kind"], F.lit(" "), h["key"])
    iris = keys.groupBy("kind", "key").agg(F.collect_set("iri").alias("iris"))
    table = iris.agg(F.map_from_entries(F.collect_list(F.struct(F.concat("kind", F.lit(" "), "key").alias("k"), "iris"))).alias("__iris"))  # one row
    x = chunks.crossJoin(F.broadcast(table))
    linked = F.flatten(F.transform(F.array_distinct(F.transform(found, name)), lambda k: F.element_at("__iris", k)))
    return x.withColumn("entities", F.array_sort(F.array_distinct(linked))).drop("__iris")
