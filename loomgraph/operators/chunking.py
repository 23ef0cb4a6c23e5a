"""Markdown sections and overlapping word windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.functions import text as T

#: Where lines end, as Python's splitlines has it.
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
_HEADING = rf"(?U)^#{{1,6}}{T.SPACE}"


def lines_of(text: Column) -> Column:
    """Lines; the empty one behind a last break is none."""
    return T.bound(F.split(text, BREAK, -1), lambda parts: F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts))


def _sections(text: Column) -> Column:
    """The sections (heading_path, body) of a text, as an array."""
    return T.bound(lines_of(text), _sections_of_lines)


def _sections_of_lines(lines: Column) -> Column:
    heads = F.filter(F.transform(lines, lambda line, i: F.struct(i.alias("i"), F.when(line.rlike(_HEADING), F.length(F.regexp_extract(line, "^#+", 0))).otherwise(0).alias("level"))), lambda h: h["level"] > 0)

    def all_of(starts: Column) -> Column:
        def section(s: Column, k: Column) -> Column:
            stop = F.coalesce(F.get(starts, k + 1)["i"], F.size(lines))
            # Headings in force at k: no heading between them and k has their level or a lower one.  Read backwards,
            # the levels form a strictly falling sequence.
            force = F.aggregate(
                F.reverse(F.slice(starts, F.lit(2), k)),
                F.struct(F.lit(7).alias("least"), F.array().cast("array<int>").alias("at")),
                lambda acc, h: F.when(h["level"] < acc["least"], F.struct(h["level"].alias("least"), F.concat(F.array(h["i"]), acc["at"]).alias("at"))).otherwise(acc),
            )
            return F.struct(force["at"].alias("at"), s["i"].alias("start"), stop.alias("stop"))

        found = F.filter(F.transform(starts, section), lambda s: s["stop"] - s["start"] > 1)
        path = lambda s: F.transform(s["at"], lambda i: T.clean_heading(F.get(lines, i)))
        body = lambda s: F.array_join(F.slice(lines, s["start"] + 2, s["stop"] - s["start"] - 1), "\n")
        return F.transform(found, lambda s: F.struct(path(s).alias("heading_path"), body(s).alias("body")))

    return T.bound(F.concat(F.array(F.struct(F.lit(-1).alias("i"), F.lit(0).alias("level"))), heads), all_of)


def sections(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with one row per section: section (its number), heading_path, body.

    A heading ends the section before it, which counts if it has a line at all.  The path of a section is, of
    each level, the last heading so far that no later heading of its level or above has closed."""
    return docs.select(*docs.columns, F.posexplode(_sections(F.col(text))).alias("section", "__s")).select(*docs.columns, "section", "__s.*")


def windows(words: Column, target: int, overlap: int) -> Column:
    """Starts (from 0) of the windows over an array of words."""
    step, n = max(1, target - overlap), F.size(words)
    last = (F.ceil((n - target) / F.lit(float(step))) * step).cast("int")
    return F.when(n <= target, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), last, F.lit(step)))


_ANY_HEADING = rf"(?U)(?:^|{BREAK})#{{1,6}}{T.SPACE}"


def _windowed(body: Column, path: Column, size: int, shared: int, min_words: int) -> Column:
    """The windows (heading_path, text, n_words) of a section that are long enough."""

    def cut(words: Column) -> Column:
        n = lambda start: F.least(F.lit(size), F.size(words) - start)
        starts = F.filter(windows(words, size, shared), lambda start: n(start) >= min_words)
        return F.transform(starts, lambda start: F.struct(path.alias("heading_path"), F.array_join(F.slice(words, start + 1, size), " ").alias("text"), n(start).cast("int").alias("n_words")))

    return T.bound(T.clean_words(body), cut)


def chunk(docs: DataFrame, slug: str, text: str = "text", tokens: int = 320, overlap: int = 48, min_words: int = 12, keep: Sequence[str] = ()) -> DataFrame:
    """id, doc, seq, heading_path, text, n_words, token_est, and the columns of the document to keep; chunks are numbered after short ones
    are dropped.

    A slug is its row's own, so that all chunks of a document come from its row, in order and numbered, in one scan without a shuffle.
    Only texts with a heading are cut in sections."""
    size, shared = T.word_budget(tokens, overlap)
    windowed = lambda body, path: _windowed(body, path, max(size, 1), shared, max(min_words, 1))
    body = F.col(text)
    cut = F.flatten(F.transform(_sections(body), lambda s: windowed(s["body"], s["heading_path"])))
    w = F.when(body.contains("#") & body.rlike(_ANY_HEADING), cut).otherwise(windowed(body, F.array().cast("array<string>")))
    d = docs.filter(body.isNotNull()).select(F.col(slug).alias("doc"), *keep, F.posexplode(w).alias("seq", "w")).select("doc", *keep, "seq", "w.*")
    return d.select(T.chunk_id("doc", "seq").alias("id"), "doc", "seq", "heading_path", "text", "n_words", T.token_estimate("n_words").alias("token_est"), *keep)


def batches(chunks: DataFrame, size: int = 120) -> DataFrame:
    """chunks plus batch_id: runs of so many chunks of a document, in order."""
    n = F.floor((F.row_number().over(W.partitionBy("doc").orderBy("seq")) - 1) / size).cast("int")
    return chunks.withColumn("batch_id", T.batch_id("doc", n))


def batch_index(batched: DataFrame, folder: str = "batches") -> DataFrame:
    """batch_id, path, n."""
    counted = batched.groupBy("batch_id").agg(F.count("*").cast("int").alias("n"))
    return counted.select("batch_id", F.concat(F.lit(f"{folder}/"), "batch_id", F.lit(".json")).alias("path"), "n")
