"""Subword ids of whole texts, as little-endian unsigned 32-bit bytes.

A byte-level tokenizer never joins a character with a space or line feed after it, so a
text may be cut before each of them and the parts encoded one by one: frequent parts
once per worker. Texts with other white space, or runs of it, are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator, Sequence

# One encoder per worker process and tokenizer file, kept between tasks.
_ENCODERS: dict[str, Encoder] = {}
_WORD_ENCODERS: dict[str, WordEncoder] = {}

CACHED_PARTS = 200_000


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for the characters from 256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids by ``tokenizers`` from a public vocabulary file, without special tokens.

    Parts of ASCII and Latin letters and signs, on whose classes all Unicode versions agree,
    are merged by ``tiktoken`` from the same file's vocabulary, which is several times faster
    for single words and gives the same ids; the tests hold the two against each other.
    ``cached_parts`` bounds memory only; a part that isn't kept is encoded again.
    """

    WHOLE = re.compile(r"[^\S \n]|[ \n]{2}")

    def __init__(self, path: str, cached_parts: int = 2 * CACHED_PARTS) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte_of = byte_letters()
        ranks = {
            bytes(byte_of[c] for c in token): i
            for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items()
            if all(c in byte_of for c in token)
        }
        merge = tiktoken.Encoding("parts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.parts = _Parts(merge.encode_ordinary, self.ids, cached_parts)

    def ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: Sequence[str]) -> Iterator[bytes]:
        """Ids of each text, whole."""
        look, one = self.parts.__getitem__, self.parts.one
        for text in texts:
            if self.WHOLE.search(text):
                yield self.ids(text)
            else:
                first, *rest = text.replace("\n", " \n").split(" ")
                yield one(first) + b"".join(map(look, rest))


class _Parts(dict):
    """Ids by part, with a space before it unless it begins with a line feed."""

    SIMPLE = re.compile("[\n -~\u00a1-\u024f]*")

    def __init__(self, merge: Callable[[str], list[int]], exact: Callable[[str], bytes], limit: int) -> None:
        self.merge, self.exact, self.limit = merge, exact, limit

    def one(self, text: str) -> bytes:
        return array("I", self.merge(text)).tobytes() if self.SIMPLE.fullmatch(text) else self.exact(text)

    def __missing__(self, part: str) -> bytes:
        ids = self.one(part if part.startswith("\n") else f" {part}")
        if len(self) < self.limit:
            self[part] = ids
        return ids


class WordEncoder:
    """Ids of single words, each with a space before it, as unsigned 16-bit bytes.

    ``path`` is a vocabulary of ranks under 65,536.
    """

    def __init__(self, path: str, cached_words: int = 2 * CACHED_PARTS) -> None:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
        pattern = public_tokenizers.PATTERN
        self.ranks = ranks
        encoding = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cache = _Words(encoding.encode_ordinary, cached_words)

    def encode(self, words: Sequence[Sequence[bytes]]) -> list[bytes]:
        """Per text (a list of words) the ids of all its words, one after the other."""
        look = self.cache.__getitem__
        return [b"".join(map(look, text)) for text in words]


class _Words(dict):
    """Ids by word; beyond the bound a new word is encoded again each time."""

    def __init__(self, encode: Callable[[str], list[int]], limit: int) -> None:
        self.encode, self.limit = encode, limit

    def __missing__(self, word: bytes) -> bytes:
        ids = array("H", self.encode(f" {word.decode('utf-8', 'replace')}")).tobytes()
        if len(self) < self.limit:
            self[word] = ids
        return ids


def word_encoder(path: str) -> WordEncoder:
    if path not in _WORD_ENCODERS:
        _WORD_ENCODERS[path] = WordEncoder(path)
    return _WORD_ENCODERS[path]


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed public vocabulary file lies; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
