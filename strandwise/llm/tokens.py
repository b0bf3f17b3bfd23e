"""Token counts and ids of whole texts with a byte-level BPE file, by the whole-token shortcut.

whole_tokens() proves with the library which vocabulary strings encode alone as exactly one token. A text is cut before each
space that stands between two characters that are no white space: the pattern of pre-tokens never crosses such a place, so
each part ("chunk") encodes by itself. A chunk that is a whole token counts 1 at once; of others the pre-tokens that are
whole tokens count 1 and only the rest is merged. Results of chunks are kept in a memory of at most 2 * MEMO entries. Texts with
other white space around a space, or with an added token's string, go to the library whole, so its defaults hold.

Null texts are empty and have 0 tokens. Rows are never dropped; repeated rows get equal results; a null id is returned as
it is. An empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import json
import re
import struct

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._runtime import modest

#: The pattern of pre-tokens of byte-level BPE files with use_regex (a fixed value of the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NAME = "byte_bpe_50k.json"
MEMO = 200_000
_SPACES = "\n\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
#: Letters in every version of Unicode: with a space in front they are one pre-token.
_WORD = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u01ff]+").fullmatch
_WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(NAME)


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level files: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Coder:
    """A tokenizer file with its library, and a merger of single pre-tokens by the same ranks."""

    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        spec = json.load(open(path, encoding="utf-8"))
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        self.added = [t["content"] for t in spec["added_tokens"]]
        alphabet = byte_alphabet()
        vocab = {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items() if t not in self.added}
        order = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = [model["vocab"]["".join(m)] for m in order]
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or ids != sorted(ids) or model.get("ignore_merges"):
            raise ValueError("not a plain byte-level BPE file")
        self.pieces = regex.compile(PATTERN)
        self._merge = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens={})._core_bpe.encode_single_piece
        self.vocab = vocab

    def whole_tokens(self) -> list[str]:
        """The vocabulary strings that the library encodes alone as their one token."""
        strings = []
        for b, i in self.vocab.items():
            try:
                strings.append((b.decode(), i))
            except UnicodeDecodeError:
                pass
        got = self.library.encode_batch([s for s, _ in strings], add_special_tokens=False)
        return [s for (s, i), e in zip(strings, got, strict=True) if e.ids == [i]]

    def merged(self, piece: str) -> list[int]:
        """The ids of one pre-token."""
        b = piece.encode()
        one = self.vocab.get(b)
        return [one] if one is not None else self._merge(b)

    def spaced(self, key: str) -> list[int]:
        """The ids of a space and a chunk."""
        return self.merged(" " + key) if _WORD(key) else self.chunk(" " + key)

    def chunk(self, text: str) -> list[int]:
        return [i for p in self.pieces.findall(text) for i in self.merged(p)]

    def plain(self, text: str) -> bool:
        """Whether the text may be cut before its spaces."""
        if "  " in text or text[-1] == " " or any(a in text for a in self.added):
            return False
        if any(c in text and (" " + c in text or c + " " in text) for c in _SPACES):
            return False
        return text.isascii() or not _WIDE.search(text)


class Memory(dict):
    """Results of chunks in two generations of at most MEMO: what is asked for again stays, the rest goes."""

    def __init__(self):
        super().__init__()
        self.old: dict = {}

    def __missing__(self, key: str):
        found = self.old.get(key)
        if found is None:
            found = self.made(key)
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


    def forget(self) -> None:
        """To be called at the end of a task, as a worker outlives it."""
        self.clear()
        self.old = {}


class Counts(Memory):
    """Number of tokens of a chunk that follows a space (the key is without it)."""

    def __init__(self, coder: Coder, whole: frozenset[str]):
        super().__init__()
        self.coder, self.whole = coder, whole

    def of(self, chunk: str) -> int:
        if chunk in self.whole:
            return 1
        return sum(1 if p in self.whole else len(self.coder.merged(p)) for p in self.coder.pieces.findall(chunk))

    def made(self, key: str) -> int:
        return self.of(" " + key)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.coder.plain(text):
            return len(self.coder.library.encode(text, add_special_tokens=False).ids)
        first, *rest = text.split(" ")
        return (self.of(first) if first else 0) + sum(map(self.__getitem__, rest))


_PACK = [struct.Struct(f"<{n}I").pack for n in range(9)]


def packed(ids: list[int]) -> bytes:
    return _PACK[len(ids)](*ids) if len(ids) < 9 else struct.pack(f"<{len(ids)}I", *ids)


class Ids(Memory):
    """Ids of a chunk that follows a space, as little-endian unsigned 32-bit integers."""

    def __init__(self, coder: Coder):
        super().__init__()
        self.coder = coder

    def made(self, key: str) -> bytes:
        return packed(self.coder.spaced(key))

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.coder.plain(text):
            return packed(self.coder.library.encode(text, add_special_tokens=False).ids)
        first, *rest = text.split(" ")
        head = packed(self.coder.chunk(first)) if first else b""
        return head + b"".join(map(self.__getitem__, rest))


_coders: dict[str, Coder] = {}
_memos: dict[tuple, dict] = {}


def coder(path: str) -> Coder:
    """Loaded once a process."""
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def counts(path: str, whole: frozenset[str]) -> Counts:
    key = ("counts", path)
    if key not in _memos:
        _memos[key] = Counts(coder(path), whole)
    return _memos[key]


def ids(path: str) -> Ids:
    key = ("ids", path)
    if key not in _memos:
        _memos[key] = Ids(coder(path))
    return _memos[key]


def counted(text: Column, path: str | None = None) -> Column:
    """The number of tokens of a string column. Only the proven strings (at most the vocabulary) are broadcast."""
    path = path or default_path()
    modest(SparkSession.active())
    cast = SparkSession.active().sparkContext.broadcast(frozenset(coder(path).whole_tokens()))

    @F.arrow_udf("long")
    def count(col: pa.Array) -> pa.Array:
        c = counts(path, cast.value)
        return pa.array((c.count(x.as_py() or "") for x in col), pa.int64())

    return count(text)


def token_counts(docs: DataFrame, *, text: str = "text", path: str | None = None, out: str = "n_tokens") -> DataFrame:
    """docs with the number of tokens of each whole text."""
    return docs.withColumn(out, counted(F.col(text), path))
