"""N-gram Jaccard self-join by a token-group matrix.

Documents with the same shingle set are one class, with a number of its own.  Classes are put in groups of similar ones; for
each group the union of those tokens of its members that can decide is kept (one row per token and group: the token-group
matrix); how many tokens of a class the matrix row of a group holds bounds its overlap with every member from above, and only
groups that reach the bound are opened and their members compared, token by token and then exactly.

Which tokens can decide, and why the bound holds without the others: in any fixed order of all tokens, two sets of n and m
tokens that overlap in t share at least l of the first n - t + l of one and m - t + l of the other, and t follows from the
similarity and the two sizes.  So the union of the members' first tokens is enough: whoever shares fewer than l of them with
a group is similar to no member.  The order puts tokens that many documents hold last (common lines and
passages), so that a token in the matrix has few holders unless the documents themselves are alike.

How groups come about: each token points from its holders to the least of them.  Such pairs are verified
exactly, and the components of the links found are the groups.  A group of thousands of near copies thus costs
one comparison for each copy rather than for each pair, and as links are only asked for up to their
components, pairs within a group need none.  Between groups no pair is passed over that can be similar.

Defined cases: a null text, or one without words, has no shingles and links with nothing; with fewer words
than a shingle the whole sequence is one; texts are whole; repeated rows are copies; rows that share a doc_id are
linked, whatever their texts (n_shingles is each row's own); rows with a null doc_id take part, and a component of such rows
alone has a null id; an empty table gives an empty result; other columns, whatever their names, are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import Stage, lean, ship, small
from loomgraph.llm.shingles import shingles
from loomgraph.operators.components import components

#: A token is common from so many holders on; so many of the commonest are kept (16 MB, sent to all tasks).
COMMON, MOST_COMMON = 16, 1_000_000
#: In a run of so many tokens of a task, those that come so often are reported; of the tokens with the lowest hashes,
#: which come first among rare ones, those that come twice.
RUN, OFTEN, LOWEST = 1_000_000, 3, int(0.3 * 2**64)


def common_tokens(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Common tokens, sorted, and how often each was seen.  This sets the order only; no result depends on it."""

    @lean
    def report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def often() -> pd.DataFrame:
            token, times = np.unique(np.concatenate(held), return_counts=True)
            kept = (times >= OFTEN) | (times >= 2) & (token < np.uint64(LOWEST))
            return pd.DataFrame({"token": token[kept].view(np.int64), "times": times[kept]})

        for pdf in batches:
            for text in pdf["text"]:
                held.append(shingles(text, n))
                size += len(held[-1])
                if size >= RUN:
                    yield often()
                    held, size = [], 0
        if held:
            yield often()

    seen = docs.filter("text is not null").select("text").mapInPandas(report, "token long, times long")
    found = seen.groupBy("token").agg(F.sum("times").alias("times")).filter(F.col("times") >= COMMON).orderBy(F.desc("times"), "token").limit(MOST_COMMON).toPandas()
    token = found["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(token)
    return token[order], found["times"].to_numpy(np.int64)[order]


#: The largest l.
DEEP = 6


def depth(n):
    """l: how many tokens two similar sets share at least among those that enter the matrix, by size (a number or a column)."""
    if isinstance(n, int):
        return 1 + min(DEEP - 1, n // 25)
    return F.lit(1) + F.least(F.lit(DEEP - 1), F.floor(n / 25)).cast("int")


def within(pos: Column, n: Column, other: Column, l: Column, percent: int) -> Column:
    """Whether a token at this place of a set of n tokens counts towards the l that a similar set of ``other`` tokens
    has to share: place <= n - t + l for an overlap t of percent * (n + other) / (100 + percent)."""
    return (pos - l) * (100 + percent) - 100 * n + percent * other <= 0


def first_tokens(s: np.ndarray, common: np.ndarray, times: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens of a set (sorted hashes) that enter the matrix: rare ones by hash, then common ones by count."""
    size = len(s)
    need = -(-percent * size // 100)
    length = min(size, size - need + depth(size))
    if not len(common):
        return s[:length]
    k = np.minimum(np.searchsorted(common, s), len(common) - 1)
    hit = common[k] == s
    rare = s[~hit]
    if len(rare) >= length:
        return rare[:length]
    last = s[hit][np.argsort(times[k[hit]], kind="stable")]
    return np.concatenate([rare, last[: length - len(rare)]])


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _as_sets(docs: DataFrame, n: int) -> DataFrame:
    @lean
    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingles(t, n) for t in pdf["text"]]
            yield pd.DataFrame({"digest": [_digest(s) for s in sets], "tokens": [s.view(np.int64) for s in sets]})

    return docs.select("text").mapInPandas(go, "digest binary, tokens array<long>")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int, stage: Stage) -> DataFrame:
    """Those of the pairs (a, b) of classes that are similar, by their whole sets, read from the texts of one document each."""
    ids = stage.write(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct().join(classes.select("rep", "doc_id", "digest"), "rep"), "ids")
    held = small(ids.filter("doc_id is not null").select("doc_id").distinct())
    wanted = docs.join(held, "doc_id", "left_semi").select("text")
    if not ids.filter("doc_id is null").isEmpty():
        wanted = wanted.unionAll(docs.filter("doc_id is null").select("text"))
    # A doc_id may have other texts, too: the digest tells which is the class's.
    sets = stage.write(_as_sets(wanted, n).join(small(ids.select("rep", "digest")), "digest").drop("digest"), "sets")
    # Several rows of one set: only where a doc_id repeats or is null.
    if not sets.groupBy("rep").agg(F.count("*").alias("rows")).filter("rows > 1").isEmpty():
        sets, whole = stage.write(sets.dropDuplicates(["rep"]), "sets"), sets
        stage.drop(whole)
    left = pairs.join(sets.select(F.col("rep").alias("b"), F.col("tokens").alias("tb")), "b")
    both = left.join(sets.select(F.col("rep").alias("a"), F.col("tokens").alias("ta")), "a")
    common, total = F.size(F.array_intersect("ta", "tb")), F.size("ta") + F.size("tb")
    both = both.select("a", "b", common.alias("i"), total.alias("t"))
    out = stage.write(both.filter(F.col("i") * 100 >= percent * (F.col("t") - F.col("i"))).select("a", "b"), "links")
    stage.drop(ids, sets)
    return out


def _sizes_fit(x: str, y: str, percent: int):
    return (F.col(x) * percent <= F.col(y) * 100) & (F.col(y) * percent <= F.col(x) * 100)


def _numbered(classes: DataFrame, stage: Stage) -> DataFrame:
    """classes plus rep, a number of its own for each: the least doc_id, so that tokens point to what came first, which copies
    resemble most; those that share theirs or have none are numbered beyond the largest (below 2^62, say)."""
    first = max(0, classes.agg(F.max("doc_id")).head()[0] or 0) + 1
    several = small(stage.write(classes.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "shared-ids"))
    own = classes.filter("doc_id is not null").join(several, "doc_id", "left_anti").withColumn("rep", F.col("doc_id"))
    rest = classes.join(several, "doc_id", "left_semi").unionByName(classes.filter("doc_id is null"))
    return stage.write(own.unionByName(rest.withColumn("rep", F.lit(first) + F.monotonically_increasing_id())), "classes")


def jaccard_classes(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id for each row."""
    spark = docs.sparkSession
    ship(spark)
    stage = Stage(spark, "jaccard")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    common = spark.sparkContext.broadcast(common_tokens(docs, n))

    @lean
    def outline(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        token, times = common.value
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                s = shingles(text, n)
                rows.append((doc, len(s), _digest(s), first_tokens(s, token, times, percent).view(np.int64)))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "digest", "first"])

    # Ids travel as strings: pandas would turn integers with nulls among them to floats.
    texts = docs.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")).alias("text"))
    outlined = texts.mapInPandas(outline, "doc_id string, n_shingles long, digest binary, first array<long>")
    outlined = stage.write(outlined.withColumn("doc_id", F.col("doc_id").cast("long")), "outlines")
    alike = outlined.filter("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("first").alias("first"))
    alike = stage.write(alike, "alike")
    outlined, whole = stage.write(outlined.select("doc_id", "n_shingles", "digest"), "outlines"), outlined
    stage.drop(whole)
    numbered = _numbered(alike, stage)
    stage.drop(alike)
    # One row per class and token, for tokens of two classes or more.
    tokens = numbered.select("rep", "n", F.posexplode("first").alias("pos", "token"))
    held = tokens.groupBy("token").agg(F.min("rep").alias("lead"), F.count("*").alias("holders")).filter("holders > 1").drop("holders")
    shared = stage.write(tokens.withColumn("pos", F.col("pos") + 1).join(held, "token"), "shared")
    classes = stage.write(numbered.drop("first"), "classes")
    stage.drop(numbered)

    texts = docs.filter("text is not null")
    pointed = shared.filter("rep <> lead").groupBy("rep", "n", "lead").agg(F.count("*").alias("c")).filter(F.col("c") >= depth(F.floor(F.col("n") * percent / 100)))
    pointed = pointed.join(small(classes.select(F.col("rep").alias("lead"), F.col("n").alias("lead_n"))), "lead")
    pointed = pointed.filter((F.col("c") >= F.least(depth(F.col("n")), depth(F.col("lead_n")))) & _sizes_fit("n", "lead_n", percent))
    tried = stage.write(pointed.select(F.col("lead").alias("a"), F.col("rep").alias("b")), "pointed")
    links = verified(tried, classes, texts, n, percent, stage)
    groups = stage.write(components(links, stage.cut), "groups")

    found = _between(shared, groups, tried, classes, texts, n, percent, stage)
    rows = stage.write(outlined.select("doc_id", "n_shingles", "digest").join(classes.select("digest", "rep"), "digest", "left").drop("digest"), "rows")
    several = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a < z")
    same = rows.join(small(stage.write(several.drop("z"), "several")), "doc_id").filter("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    ends = components(links.union(found).union(same), stage.cut).select(F.col("node").alias("rep"), "component")
    named = stage.write(classes.select("rep", "doc_id").join(ends, "rep", "left").withColumn("component", F.coalesce("component", "rep")), "ends")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    ids = named.select("rep", "component").join(least, "component").drop("component")
    return rows.join(ids, "rep", "left").select("doc_id", "n_shingles", F.coalesce("component_id", F.when(F.col("rep").isNull(), F.col("doc_id"))).alias("component_id"))


def _between(shared: DataFrame, groups: DataFrame, tried: DataFrame, classes: DataFrame, texts: DataFrame, n: int, percent: int, stage: Stage) -> DataFrame:
    """Links between members of different groups, by the token-group matrix."""
    own = shared.join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left").select("token", "rep", "n", "pos", F.coalesce("component", "rep").alias("grp"))
    grouped = stage.write(own, "grouped")
    stage.drop(shared)
    # The matrix, of tokens that more than one group holds: the range of sizes of the members that hold a token, and
    # how early it comes at best (the part of ``within`` that depends on the member).
    several = grouped.groupBy("token").agg((F.min("grp") < F.max("grp")).alias("wide")).filter("wide").select("token")
    wide = stage.write(grouped.join(several, "token", "left_semi"), "wide")
    stage.drop(grouped)
    # Whoever holds fewer such tokens than a similar pair shares is out, as one who asks and as a member.
    enough = wide.groupBy("rep", "n").agg(F.count("*").alias("c")).filter(F.col("c") >= depth(F.floor(F.col("n") * percent / 100))).select("rep")
    own = stage.write(wide.join(small(stage.write(enough, "asking")), "rep", "left_semi"), "enough")
    stage.drop(wide)
    early = F.min(F.col("pos") * (100 + percent) - 100 * F.col("n")).alias("early")
    matrix = own.groupBy("token", F.col("grp").alias("other")).agg(F.min("n").alias("low"), F.max("n").alias("high"), early)
    near = (F.col("n") * percent <= F.col("high") * 100) & (F.col("low") * percent <= F.col("n") * 100) & (F.col("other") < F.col("grp"))
    smallest = F.greatest(F.col("low"), F.ceil(F.col("n") * percent / 100))  # of a similar member
    near = near & within(F.col("pos"), F.col("n"), smallest, F.lit(DEEP), percent) & (F.col("early") - DEEP * (100 + percent) + percent * F.col("n") <= 0)
    hits = stage.write(own.join(matrix, "token").filter(near).select("token", "rep", "n", "pos", "other"), "hits")
    least = depth(F.floor(F.col("n") * percent / 100))
    opened = hits.groupBy("rep", "n", "other").agg(F.count("*").alias("c")).filter(F.col("c") >= least).select("rep", "other")

    asking = hits.join(opened, ["rep", "other"], "left_semi").select("token", F.col("other").alias("grp"), F.col("rep").alias("b"), F.col("n").alias("bn"), F.col("pos").alias("bp"))
    members = own.select("token", "grp", F.col("rep").alias("a"), F.col("n").alias("an"), F.col("pos").alias("ap"))
    l = F.least(depth(F.col("an")), depth(F.col("bn")))
    early = within(F.col("ap"), F.col("an"), F.col("bn"), l, percent) & within(F.col("bp"), F.col("bn"), F.col("an"), l, percent)
    pairs = asking.join(members, ["token", "grp"]).filter(_sizes_fit("an", "bn", percent) & early).groupBy("a", "an", "b", "bn").agg(F.count("*").alias("c"))
    pairs = pairs.filter(F.col("c") >= l).select("a", "b")
    done = tried.union(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = stage.write(pairs.join(done, ["a", "b"], "left_anti"), "pairs")
    stage.drop(own, hits)
    return verified(pairs, classes, texts, n, percent, stage)
