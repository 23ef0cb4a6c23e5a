"""URL filter: a blocked Bloom filter of listed URL rules lets possible hits through to an exact hash join.

A rule is (host, path, action) and fits its host and all subdomains where the url's path starts with the
rule's.  A url's candidates are its host's suffixes, each with the prefixes of its path that are as long as
some listed path.  The filter, of bounded size whatever the list's length, is built in Spark and sent to all
tasks; a candidate sets eight bits within one 512-bit block, so that a probe touches one cache line.  Only
candidates that pass are joined with the list itself, which removes false positives.

Defined cases: a null url, or one without ``://``, has an empty host and path and gets the default verdict
unless a rule has an empty host; the longest rule (host and path together) wins, then the longer host, then
``block``; repeated rows are judged each; an empty table or list gives an empty result or default verdicts;
other columns, whatever their names, are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import Stage, ship, small

#: Blocks of 512 bits: as many as the list needs at 16 bits a key, but at most 64 MB.
BITS_PER_KEY, MAX_BLOCKS = 16, 1 << 20


def with_host_and_path(pages: DataFrame) -> DataFrame:
    rest = F.expr("if(instr(url, '://') > 0, substring(url, instr(url, '://') + 3), '')")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})


def _places(keys: list[str], blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each key its block, and eight 64-bit masks, one per word of the block."""
    h = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))
    block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    bit = (mixed[:, None] >> np.arange(0, 48, 6, dtype=np.uint64)) & np.uint64(63)
    return block.astype(np.int64), np.uint64(1) << bit


def build_filter(keys: DataFrame) -> tuple[np.ndarray, int]:
    """A (blocks, 8) array of words, from a table with one column of strings."""
    n = keys.count()
    blocks = max(1, min(MAX_BLOCKS, -(-n * BITS_PER_KEY // 512)))

    def masks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            block, mask = _places(pdf.iloc[:, 0].tolist(), blocks)
            yield pd.DataFrame({"block": block} | {f"w{i}": mask[:, i].view(np.int64) for i in range(8)})

    rows = keys.mapInPandas(masks, "block long, " + ", ".join(f"w{i} long" for i in range(8)))
    found = rows.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8))).toPandas()  # 72 bytes a block
    words = np.zeros((blocks, 8), np.int64)
    words[found["block"].to_numpy()] = found.drop(columns="block").to_numpy()
    return words.view(np.uint64), blocks


def passes(keys: list[str], words: np.ndarray, blocks: int) -> np.ndarray:
    block, mask = _places(keys, blocks)
    return ((words[block] & mask) == mask).all(axis=1)


def suffixes(host: str) -> list[str]:
    out = [host]
    while (i := out[-1].find(".")) >= 0:
        out.append(out[-1][i + 1 :])
    return out


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for each row."""
    spark = pages.sparkSession
    ship(spark)
    stage = Stage(spark, "urls")
    rules = rules.select(F.coalesce("host", F.lit("")).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), "action").distinct()
    # A host of its own is a key too, so that paths are tried only below listed hosts.
    keys = rules.select(F.concat("r_host", F.lit(" "), "r_path")).union(rules.select("r_host")).distinct()
    words, blocks = build_filter(keys)
    lengths = sorted(r[0] for r in rules.select(F.length("r_path")).distinct().collect())
    held = spark.sparkContext.broadcast((words, lengths))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, lengths = held.value
        for pdf in batches:
            rows = [(h, p, s) for h, p in zip(pdf["host"], pdf["path"], strict=True) for s in suffixes(h)]
            rows = [r for r, ok in zip(rows, passes([r[2] for r in rows], words, blocks), strict=True) if ok]
            rows = [(h, p, s, p[:n]) for h, p, s in rows for n in lengths if n <= len(p)]
            rows = [r for r, ok in zip(rows, passes([f"{s} {q}" for _, _, s, q in rows], words, blocks), strict=True) if ok]
            yield pd.DataFrame(rows, columns=["h", "p", "c_host", "c_path"])

    urls = with_host_and_path(pages).select("page_id", "host", "path")
    possible = urls.select("host", "path").mapInPandas(probe, "h string, p string, c_host string, c_path string").distinct()
    found = possible.join(small(rules), (F.col("c_host") == F.col("r_host")) & (F.col("c_path") == F.col("r_path")))
    order = F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host"), F.col("action"))
    best = stage.write(found.groupBy("h", "p").agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), "action"), order).alias("best")), "best")
    out = urls.join(small(best), (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
