"""Token counts of whole texts, by overlap resynchronisation for huge ones.

A text of up to ``HUGE`` characters is counted word by word (``tokens.WordCounts``).  A longer one is
encoded in overlapping chunks with offsets: two neighbours are spliced where both begin a token at a
boundary that is proven stable (a space behind anything but white space: no token crosses it, and what
follows is encoded alike whatever stands before) and where they agree on all tokens from there to the
last stable boundary of their overlap.  Where an overlap holds no such place it is widened, to the rest
of the text if need be, so that the count is always that of the whole text.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows are counted each; an empty
table gives an empty result; other columns, whatever their names, are ignored; special strings inside a text count as the
library takes them, for which such a text is encoded whole."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm import tokens
from loomgraph.llm.common import ship

#: Characters from which on a text is cut in chunks, of a chunk, and of an overlap at first.
HUGE, CHUNK, OVERLAP = 16_384, 4_096, 128

_STABLE = re.compile(r"(?<=\S) (?=\S)")


def spliced_ids(text: str, path: str, chunk: int = CHUNK, overlap: int = OVERLAP, widened: list[int] | None = None) -> list[int]:
    """Ids of the whole text, from chunks; ``widened`` collects the overlaps that had to be widened."""
    lib = tokens.library(path)
    if any(s in text for s in tokens.specials(path)):
        return lib.encode(text, add_special_tokens=False).ids

    def encode(a: int, b: int) -> list[tuple[int, int]]:
        """(start, id); tokens of one character share a start."""
        e = lib.encode(text[a:b], add_special_tokens=False)
        return [(a + s, i) for (s, _), i in zip(e.offsets, e.ids, strict=True)]

    out: list[int] = []
    at, here, stop = 0, encode(0, min(chunk, len(text))), min(chunk, len(text))
    while stop < len(text):
        width = overlap
        while True:
            begin = max(at, stop - width)
            end = min(len(text), stop + chunk)
            marks = [m.start() for m in _STABLE.finditer(text, begin, stop)]
            marks = [m for m in marks if m > at]
            there = None
            if len(marks) > 1:
                there = encode(begin, end)
                p, last = marks[0], marks[-1]
                mine = [x for x in here if p <= x[0] < last]
                if mine and mine == [x for x in there if p <= x[0] < last] and mine[0][0] == p:
                    out += [i for s, i in here if at <= s < p]
                    at, here, stop = p, there, end
                    break
            if begin <= at:  # no place in the whole chunk: encode on, from its start
                stop = min(len(text), stop + 2 * (stop - at))
                here = encode(at, stop)
                break
            width *= 2
            if widened is not None:
                widened.append(width)
    return out + [i for s, i in here if s >= at]


def count_tokens(text: str, path: str) -> int:
    return len(spliced_ids(text, path)) if len(text) > HUGE else tokens.words_of("counts", path)(text)


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row."""
    ship(docs.sparkSession)

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(lambda t: count_tokens(t, path))

    text = F.coalesce("text", F.lit(""))
    out = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), count(text).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
