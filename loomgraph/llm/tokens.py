"""Public tokenizers, one word at a time from a bounded cache.

Both vocabularies cut a text at white space before they merge bytes, so that the ids of a text are
those of its words one after another.  A word seen before costs one look-up.  A new word made of
well-known letters is merged from the vocabulary's byte ranks; any other goes to the library itself."""

from __future__ import annotations

import re
from functools import lru_cache
from struct import pack

#: Words of a cache; beyond it, it starts anew.  About 200 bytes each.
CACHE = 200_000
#: Letters whose class and lower case no Unicode version changes: ASCII without controls, Latin-1, Latin Extended-A.
PLAIN = re.compile("[\x09\x0a\x20-\x7e¡-¬®-İĲ-ž]*")


@lru_cache(maxsize=8)
def library(path: str):
    """The tokenizer of the library, with its defaults."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=8)
def specials(path: str) -> tuple[str, ...]:
    """Strings that the library takes for special tokens wherever they stand in a text."""
    import json

    with open(path, encoding="utf-8") as f:
        return tuple(x["content"] for x in json.load(f)["added_tokens"])


def byte_alphabet() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else the next from U+0100."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(0x100 + i): b for i, b in enumerate(others)}


class _Words:
    """A bounded cache from words to what is wanted of them."""

    def __init__(self, path: str):
        self.path, self.cache = path, {"": self.empty}
        self.special = specials(path)

    def _merger(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def look(self, words: list[str]) -> list:
        cache = self.cache
        try:
            return [cache[w] for w in words]
        except KeyError:
            pass
        if len(cache) > CACHE:
            self.cache = cache = {"": self.empty}
        new = {w for w in words if w not in cache}
        odd = [w for w in new if not (w.isascii() and w.isprintable() or PLAIN.fullmatch(w))]
        for w in new.difference(odd):
            cache[w] = self.merge(w)
        if odd:
            for w, e in zip(odd, library(self.path).encode_batch_fast([self.prefix + w for w in odd], add_special_tokens=False), strict=True):
                cache[w] = self.keep(e.ids)
        return [cache[w] for w in words]


class WordIds(_Words):
    """Ids, as unsigned 32-bit little-endian bytes, for a vocabulary with word ends that drops white space."""

    empty, prefix = b"", ""

    def __init__(self, path: str):
        import json

        import regex

        super().__init__(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        end, byte = spec["model"]["end_of_word_suffix"], byte_alphabet()
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern).findall
        #: A byte that no UTF-8 text holds stands for the end of a word.
        as_bytes = lambda t: bytes(byte[c] for c in t.removesuffix(end)) + b"\xff" * t.endswith(end)
        ranks = {as_bytes(t): i for t, i in spec["model"]["vocab"].items()}
        #: The end alone is no token; it merges first with what stands before it, as those ids are lowest.
        self.piece = self._merger(ranks, pattern)._core_bpe.encode_single_piece

    def keep(self, ids: list[int]) -> bytes:
        return pack(f"<{len(ids)}I", *ids)

    def merge(self, word: str) -> bytes:
        word = word.lower()
        if word.isalpha():
            return self.keep(self.piece(word.encode() + b"\xff"))
        ids: list[int] = []
        for p in self.pieces(word):
            ids += self.piece(p.encode() + b"\xff")
        return self.keep(ids)

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.keep(library(self.path).encode(text, add_special_tokens=False).ids)
        return b"".join(self.look(text.replace("\n", " ").split(" ")))


class WordCounts(_Words):
    """Numbers of tokens for a byte-level vocabulary in which a space belongs to the word behind it."""

    empty, prefix = 0, " "

    def __init__(self, path: str):
        import json

        import public_tokenizers

        super().__init__(path)
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        byte = byte_alphabet()
        self.encoding = self._merger({bytes(byte[c] for c in t): i for t, i in vocab.items()}, public_tokenizers.PATTERN)
        del self.cache[""]

    def keep(self, ids: list[int]) -> int:
        return len(ids)

    def merge(self, word: str) -> int:
        return len(self.encoding.encode_ordinary(" " + word))

    #: A token holds a space only as its first character, so that one may cut before a space that follows
    #: anything but white space.
    unsafe = re.compile(r"\s | $")
    cuts = re.compile(r"(?<=\S) ")

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        if any(s in text for s in self.special):
            return len(library(self.path).encode(text, add_special_tokens=False).ids)
        first, *words = self.cuts.split(text) if self.unsafe.search(text) else text.split(" ")
        head = len(self.encoding.encode_ordinary(first)) if PLAIN.fullmatch(first) else len(library(self.path).encode(first, add_special_tokens=False).ids)
        return head + sum(self.look(words))


@lru_cache(maxsize=4)
def words_of(kind: str, path: str) -> _Words:
    return {"ids": WordIds, "counts": WordCounts}[kind](path)
