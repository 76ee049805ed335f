"""Encoding texts by the tokenizers library, one distinct white-space delimited word at a time.

The vocabulary file's pre-tokenizer never joins characters across white space, so a text's ids are its words' ids in
order. `split` follows the library's white space; the control characters 1C to 1F, which Python splits at, are not.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"
#: Words, and pieces of words, that a Python worker remembers: about 250 MB.
CACHE_WORDS = 800_000

_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
# Printable ASCII and the letters of Latin-1: here lower-casing and composition are the same in every library.
_PLAIN = re.compile("[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z\xdf-\xf6\xf8-\xff0-9]+")
_PLAIN_TEXT = re.compile("[\t-\r -~\xa0\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
_ALL_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\t-\r \xa0a-z\xdf-\xf6\xf8-\xff0-9]+")
_JOINED = 512


def split(text: str) -> list[str]:
    if _SEPARATORS.search(text):
        return [w for w in _SPACE.split(text) if w]
    return text.split()


class WordEncoder:
    """Ids of words as little-endian unsigned 16-bit (vocabularies up to 65,536) bytes, remembered up to a bound."""

    def __init__(self, path: str, limit: int = CACHE_WORDS) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        if size > 65_536:
            raise ValueError(f"{size} ids do not fit in 16 bits")
        self.pieces = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.ends = np.array([p.endswith("</w>") for p in self.pieces])
        self.limit, self.words, self.parts = limit, {}, {}

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u2")

    def _learn_parts(self, parts: list[str]) -> None:
        for at in range(0, len(parts), _JOINED):
            some = parts[at : at + _JOINED]
            ids = self._encode(" ".join(some))
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some) and (not len(ends) or ends[-1] == len(ids)):
                whole, starts = ids.tobytes(), [0, *ends.tolist()]
                for k, part in enumerate(some):
                    self.parts[part] = whole[2 * starts[k] : 2 * starts[k + 1]]
            else:  # a piece without an end mark: ask for each word on its own
                for part in some:
                    self.parts[part] = self._encode(part).tobytes()

    def forget(self) -> None:
        """Drop what goes beyond the bound."""
        for known in (self.words, self.parts):
            if len(known) > self.limit:
                known.clear()

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words not yet known."""
        plain, known, pieces = {}, self.parts, set()
        for word in words:
            if word.isascii() and word.isalpha():
                plain[word] = found = (word.lower(),)
            elif "<|" not in word and _PLAIN.fullmatch(word):
                plain[word] = found = _PIECES.findall(word.lower())
            else:
                self.words[word] = self._encode(word).tobytes()
                continue
            pieces.update(found)
        self._learn_parts([p for p in pieces if p not in known])
        for word, found in plain.items():
            self.words[word] = known[found[0]] if len(found) == 1 else b"".join([known[p] for p in found])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text: by pieces where the text is plain, by words elsewhere."""
        self.forget()
        plain = [_PLAIN_TEXT.fullmatch(t) is not None and "<|" not in t for t in texts]
        units = [_ALL_PIECES.findall(t.lower()) if p else split(t) for t, p in zip(texts, plain, strict=True)]
        tables = [self.parts.get if p else self.words.get for p in plain]
        found = [list(map(known, some)) for known, some in zip(tables, units, strict=True)]
        missing: tuple[set[str], set[str]] = set(), set()
        for p, some, ids in zip(plain, units, found, strict=True):
            if None in ids:
                missing[p].update(u for u, x in zip(some, ids, strict=True) if x is None)
        if missing[0]:
            self.learn(missing[0])
        self._learn_parts([u for u in missing[1] if u not in self.parts])
        return [b"".join(map(known, some) if None in ids else ids) for known, some, ids in zip(tables, units, found, strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker."""
    return WordEncoder(path)


def default_path() -> str:
    return public_tokenizers.path(VOCABULARY)
