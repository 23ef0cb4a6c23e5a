"""Line dedup: a suffix array over sequences of line ids, by distributed prefix doubling.

Every line gets an id; a line that occurs once ends any repeat, so only stretches of lines that each occur
again take part, cut at all others.  Ranks of the stretches' suffixes by their first 1, 2, 4, ... lines come
from prefix doubling: the pairs (rank, rank so many lines on) are counted, put in order by range partitions,
and numbered by running sums, so that a rank is the place in the suffix array where the interval of suffixes
with that common prefix begins.  Two ranks name the interval whose longest common prefix is a run of any
length.  A run of at least ``min_words`` words that lies in an interval of several suffixes is a repeat; the
earliest suffix of the interval, in order of (document, line), is kept, and the lines of all others go.

Doubling goes as far as it can decide: a line has a word at least, so the shortest run of ``min_words`` words from
any line has that many lines at most, and no suffix is told from another by more.  Maximal repeated runs
(``maximal_runs``) are chains of such shortest runs whose earliest copies follow one another likewise: for each line the
shortest that begins there and the shortest that ends there.  A line lies in a later copy of a maximal run if and only if
it lies in a later copy of one of these, as the occurrences of a run and of what surrounds all of them are the same in number
and order.

DataFrame functions only.  Lines travel as 128-bit hashes, positions and word counts; texts are joined with the
numbers of the lines to delete once, at the end.  No step gathers a key: counts are partial sums, frequent ids and intervals
are broadcast (fewer than a thousand by their definition) and only the others are shuffled.

Defined cases: lines end at newlines only; a line counts as one word at least, so that empty lines are part of
runs; a null text stays null; a repeat within a document counts (of a run that overlaps its own earlier copy,
what the earlier copy does not begin with goes); a text whose lines all go becomes empty; each row is a
document of its own: rows of one doc_id come in order of their content, rows without one after all others.  An
empty table gives an empty result; other columns are kept, but for n_lines and n_removed, which are replaced; names
that begin with two underscores are the operator's own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.llm.common import WORD, Stage, join_counted, small

#: Words of the shortest run that counts as a repeat.
MIN_WORDS = 20


def with_keys(docs: DataFrame, stage: Stage) -> DataFrame:
    """docs plus __key (none, id, nth), which tells all rows apart: in order of doc_id, of rows of one doc_id in order of
    their content, rows without a doc_id last.

    nth is -1 where the doc_id is the row's own.  Only rows without one are sorted, by range partitions, and written."""
    counts = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
    twice = small(stage.write(counts.filter("n > 1").select("doc_id"), "twice"))
    own = docs.filter("doc_id is not null").join(twice, "doc_id", "left_anti").select("*", F.lit(-1).cast("long").alias("__nth"))
    rest = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    order = ["doc_id", "__text", "__row", "__any"]
    shared = docs.join(twice, "doc_id", "left_semi").select(docs.columns).unionByName(docs.filter("doc_id is null"))
    # The last number parts rows that are equal throughout, however many.
    shared = shared.withColumns({"__text": F.md5("text"), "__row": F.xxhash64(*rest), "__any": F.rand(1)})
    shared = shared.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__nth", F.monotonically_increasing_id())
    shared = stage.write(shared.select(*docs.columns, "__nth"), "shared-ids")
    kind = docs.schema["doc_id"].dataType
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0).cast(kind)).alias("id"), F.col("__nth").alias("nth"))
    return own.select(*docs.columns, "__nth").unionByName(shared).withColumn("__key", key).drop("__nth")


def _lines(docs: DataFrame, key: str) -> DataFrame:
    """doc, pos, id, w: of each line its hash and its words."""
    rows = docs.filter(F.col("text").isNotNull()).select(F.col(key).alias("doc"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return rows.select("doc", "pos", F.unhex(F.md5("line")).alias("id"), F.greatest(F.lit(1), F.regexp_count("line", F.lit(WORD))).alias("w"))


def _stretches(lines: DataFrame, min_words: int, stage: Stage) -> DataFrame:
    """doc, seg, pos, id and the lengths (in lines) of the shortest runs that begin (ahead) and end (back) at a
    line; null where the stretch is too short for one."""
    again = stage.write(lines.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1"), "again")
    kept = join_counted(lines, again, ["id"])
    kept = kept.withColumn("seg", F.col("pos") - F.row_number().over(W.partitionBy("doc").orderBy("pos")))
    seg = W.partitionBy("doc", "seg")
    kept = kept.withColumn("stop", F.sum("w").over(seg.orderBy("pos").rowsBetween(W.unboundedPreceding, 0))).withColumn("start", F.col("stop") - F.col("w"))
    # Every line has a word at least, so starts and stops are strictly increasing.
    ahead = F.count("*").over(seg.orderBy("start").rangeBetween(0, min_words - 1))
    back = F.count("*").over(seg.orderBy("stop").rangeBetween(-(min_words - 1), 0))
    kept = kept.withColumn("all", F.sum("w").over(seg)).filter(F.col("all") >= min_words)
    kept = kept.withColumn("ahead", F.when(F.col("all") - F.col("start") >= min_words, ahead)).withColumn("back", F.when(F.col("stop") >= min_words, back))
    return kept.select("doc", "seg", "pos", "id", F.col("ahead").cast("int"), F.col("back").cast("int"))


def _ranked(keys: DataFrame, columns: list[str], stage: Stage) -> DataFrame:
    """keys (with n, the suffixes of each) plus rank: how many suffixes come before, in order of the columns.

    Range partitions are summed on their own; their offsets are a running sum over as many rows as partitions."""
    parts = stage.write(keys.repartitionByRange(*columns).withColumn("part", F.spark_partition_id()), "ordered")
    whole = parts.groupBy("part").agg(F.sum("n").alias("total"))
    offset = whole.select("part", (F.sum("total").over(W.orderBy("part")) - F.col("total")).alias("before"))
    inside = F.sum("n").over(W.partitionBy("part").orderBy(*columns).rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    return parts.withColumn("inside", inside).join(F.broadcast(offset), "part").select(*columns, "n", (F.col("before") + F.col("inside")).alias("rank"))


def _doubled(rows: DataFrame, level: int, stage: Stage) -> DataFrame:
    """rows (doc, seg, pos, ..., r<level>) plus r<level + 1>, the rank by twice as many lines."""
    one, two = f"r{level}", f"r{level + 1}"
    ahead = F.lead(one, 1 << level).over(W.partitionBy("doc", "seg").orderBy("pos"))
    rows = stage.write(rows.withColumn("next", F.coalesce(ahead, F.lit(-1))), "next")  # a suffix that ends comes first
    pairs = rows.groupBy(one, "next").agg(F.count("*").alias("n"))
    ranks = _ranked(pairs, [one, "next"], stage).withColumnRenamed("rank", two)
    return stage.write(join_counted(rows, stage.write(ranks, "numbered"), [one, "next"]).drop("next"), "ranks")


def suffix_ranks(rows: DataFrame, levels: int, stage: Stage) -> DataFrame:
    """rows (doc, seg, pos, id, ...) with r0 .. r<levels>: ranks in the suffix array by 1, 2, 4, ... lines."""
    ids = _ranked(rows.groupBy("id").agg(F.count("*").alias("n")), ["id"], stage).withColumnRenamed("rank", "r0")
    rows = stage.write(join_counted(rows, stage.write(ids, "numbered"), ["id"]).drop("id"), "ranks")
    for level in range(levels):
        rows = _doubled(rows, level, stage)
    return rows


def _runs(rows: DataFrame, longest: int) -> DataFrame:
    """doc, pos, len, k1, k2: the runs and the two ranks that name their intervals.

    A run of len lines is the union of two of 2 ** level lines, one from its start and one up to its end; both ranks are read a
    number of rows ahead or back that depends on len alone."""
    seg = W.partitionBy("doc", "seg").orderBy("pos")
    level = lambda n: n.bit_length() - 1

    def pick(length: str, value: Callable[[int], Column]) -> Column:
        out = F.lit(None)
        for n in range(longest, 0, -1):
            out = F.when(F.col(length) == n, value(n)).otherwise(out)
        return out

    rank = lambda n, ahead: F.lead(f"r{level(n)}", ahead).over(seg)
    x = rows.select(
        "doc", "pos", "ahead", "back",
        pick("ahead", lambda n: rank(n, 0)).alias("a1"), pick("ahead", lambda n: rank(n, n - (1 << level(n)))).alias("a2"),
        pick("back", lambda n: rank(n, 1 - n)).alias("b1"), pick("back", lambda n: rank(n, 1 - (1 << level(n)))).alias("b2"),
    )
    run = lambda pos, length, k1, k2: F.struct(pos.alias("pos"), F.col(length).alias("len"), F.col(k1).alias("k1"), F.col(k2).alias("k2"))
    ahead, back = run(F.col("pos"), "ahead", "a1", "a2"), run(F.col("pos") - F.col("back") + 1, "back", "b1", "b2")
    both = F.filter(F.array(ahead, back), lambda r: r["len"].isNotNull())
    return x.select("doc", F.explode(both).alias("x")).select("doc", "x.*").distinct()


def later_runs(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "__key") -> DataFrame:
    """doc, pos, len, first_doc, first_pos: every shortest run that has an earlier copy, and the earliest."""
    stage = Stage(docs.sparkSession, "lines")
    lines = stage.write(_lines(docs.select(key, "text"), key), "lines")
    rows = stage.write(_stretches(lines, min_words, stage), "stretches")
    longest = rows.agg(F.max(F.greatest("ahead", "back"))).head()[0] or 1
    runs = stage.write(_runs(suffix_ranks(rows, int(longest).bit_length() - 1, stage), int(longest)), "runs")
    name = ["len", "k1", "k2"]
    first = runs.groupBy(*name).agg(F.min(F.struct("doc", "pos")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = join_counted(runs, stage.write(first, "first"), name).filter(F.struct("doc", "pos") != F.col("first"))
    return stage.write(later.select("doc", "pos", "len", F.col("first.doc").alias("first_doc"), F.col("first.pos").alias("first_pos")), "later")


def maximal_runs(later: DataFrame) -> DataFrame:
    """doc, start, stop, first_doc, first_start: maximal runs of lines that repeat an earlier copy, of ``later_runs``.

    Runs with the same place relative to their copies form a chain as far as they overlap or touch."""
    chain = ["doc", "first_doc", "shift"]
    x = later.withColumns({"shift": F.col("pos") - F.col("first_pos"), "stop": F.col("pos") + F.col("len") - 1})
    before = F.max("stop").over(W.partitionBy(*chain).orderBy("pos", "stop").rowsBetween(W.unboundedPreceding, -1))
    x = x.withColumn("new", F.when(F.coalesce(F.col("pos") > before + 1, F.lit(True)), 1).otherwise(0))
    x = x.withColumn("nth", F.sum("new").over(W.partitionBy(*chain).orderBy("pos", "stop").rowsBetween(W.unboundedPreceding, 0)))
    found = x.groupBy(*chain, "nth").agg(F.min("pos").alias("start"), F.max("stop").alias("stop"))
    return found.select("doc", "start", "stop", "first_doc", (F.col("start") - F.col("shift")).alias("first_start"))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "__key") -> DataFrame:
    """doc, gone: of each document that loses lines, the ranges (start, stop) of their numbers from 0."""
    runs = maximal_runs(later_runs(docs, min_words, key))
    order = W.partitionBy("doc").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(W.unboundedPreceding, -1))
    runs = runs.withColumn("new", F.when(F.coalesce(F.col("start") > before + 1, F.lit(True)), 1).otherwise(0))
    runs = runs.withColumn("nth", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    ranges = runs.groupBy("doc", "nth").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return ranges.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("gone"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with later copies of repeated line runs deleted from ``text``, plus n_lines and n_removed."""
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    docs = with_keys(docs.select(*rest, "text"), Stage(docs.sparkSession, "rows"))
    gone = repeated_lines(docs, min_words).select(F.col("doc").alias("__doc"), F.col("gone").alias("__gone"))
    joined = docs.join(gone, F.col("__key") == F.col("__doc"), "left")
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda line, i: ~F.exists("__gone", lambda g: i.between(g["start"], g["stop"])))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    removed = F.aggregate("__gone", F.lit(0), lambda n, g: n + g["stop"] - g["start"] + 1)
    counts = [F.coalesce(F.when(F.col("text").isNotNull(), F.size(lines)), F.lit(0)).alias("n_lines"), F.coalesce(removed, F.lit(0)).alias("n_removed")]
    return joined.select(*rest, text.alias("text"), *counts)
