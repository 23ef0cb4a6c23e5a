import random

import pytest

from loomgraph.llm import token_counts, tokens
from loomgraph.llm.queries import BYTE_BPE, WORD_BPE

from cases import documents, empty

ODD = ["", " ", "  a  b ", "x<|endoftext|>y", "<|startoftext|>", " lead", "trail ", "tab\there", "a\n\n b", "\x1c!x \x1c", "don't I'LL it's", "İstanbul ΣΑΣ ςσ", "你好 世界", "a\u2003b \u00a0 c", "e\u0301 \u0301x", "1234 5 ½ ² a1b2", "\r\nfoo\r bar", "ﬁ ŉ Ŀ ĳ ſ", "👍🏽 ok", "foo \n bar  \n", "\x00\x0b \x0c"]


def random_texts(n):
    rng = random.Random(8)
    parts = ["the", "Thin,", "é", "ß", " ", "  ", "\n", "'s", "12", "!!", "\t", "Ünder", "x" * 40, "日本", "\u00a0", "\u0301"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert tokens.words_of("ids", WORD_BPE)(text) == tokens.WordIds.keep(None, tokens.library(WORD_BPE).encode(text, add_special_tokens=False).ids)
    assert tokens.words_of("counts", BYTE_BPE)(text) == len(tokens.library(BYTE_BPE).encode(text, add_special_tokens=False).ids)


def test_random_texts():
    ids, counts = tokens.words_of("ids", WORD_BPE), tokens.words_of("counts", BYTE_BPE)
    for text in random_texts(400):
        assert ids(text) == ids.keep(tokens.library(WORD_BPE).encode(text, add_special_tokens=False).ids), text
        assert counts(text) == len(tokens.library(BYTE_BPE).encode(text, add_special_tokens=False).ids), text


def test_splices_give_the_ids_of_the_whole_text():
    rng = random.Random(2)
    for chunk, overlap in ((40, 4), (200, 20)):
        for text in [*("".join(random_texts(6)) for _ in range(20)), "x" * 900, "ab " * 300, " " * 500, "a" * 300 + " b" * 100]:
            whole = tokens.library(BYTE_BPE).encode(text, add_special_tokens=False).ids
            assert token_counts.spliced_ids(text, BYTE_BPE, chunk, overlap) == whole
    huge = " ".join(rng.choice(["lorem", "ipsum,", "dolor\n", "é"]) for _ in range(40_000))
    assert token_counts.count_tokens(huge, BYTE_BPE) == len(tokens.library(BYTE_BPE).encode(huge, add_special_tokens=False).ids)


def test_huge_texts_by_splices(spark):
    """Texts without a stable boundary for long force wider overlaps."""
    rng = random.Random(12)
    texts = []
    for i in range(30):
        parts = [rng.choice(["lorem", "ipsum,", "dolor\n", "é", "x" * rng.choice([5, 300, 900]), " \n "]) for _ in range(rng.randint(400, 3000))]
        texts.append((" " if i % 3 else "").join(parts))
    widened = []
    for t in texts:
        want = tokens.library(BYTE_BPE).encode(t, add_special_tokens=False).ids
        assert token_counts.spliced_ids(t, BYTE_BPE, widened=widened) == want
    assert len(widened) > 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(df, BYTE_BPE).collect()}
    assert got == {i: len(tokens.library(BYTE_BPE).encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_table(spark):
    docs = documents(spark)
    for r in token_counts.token_counts(docs, BYTE_BPE).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        n = len(tokens.library(BYTE_BPE).encode(r["text"] or "", add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((r["text"] or "").encode()), n > 1024)
    assert token_counts.token_counts(docs, BYTE_BPE).count() == docs.count()
    assert token_counts.token_counts(empty(spark), BYTE_BPE).count() == 0
