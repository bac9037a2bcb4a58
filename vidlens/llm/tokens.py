"""Token ids by the tokenizers library, with a word-level memory (used inside tasks)."""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import regex

#: Id written after every document.
END_ID = 2
#: Pieces remembered by a Python worker (some 250 bytes each); beyond it they are encoded anew.
CACHED_PIECES = 500_000

# Texts of these characters only are split here; any other text goes whole to
# the library.  Their classes (letter, digit, other) and their case and normal
# forms do not depend on the Unicode version: ASCII, and Latin letters and signs
# below U+0180 without the no-break space, the soft hyphen and the dotted I.
_UNUSUAL = re.compile("[^\t\n\r -~\u00a1-\u00ac\u00ae-\u012f\u0131-\u017f\u2013\u2014\u2018\u2019\u201c\u201d]")
_SPACES = ("  ", "\n\n", " \n", "\n ", "\t", "\r")


# The split patterns named by the two kinds of vocabulary file.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORD_END = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """``encode(texts)``: for every text the array of its ids.

    The library encodes each part of a text between white space once (with the
    space before it, where the vocabulary keeps spaces); the ids of a text are
    those of its parts in order, since merges never cross them.  Texts with
    characters outside a fixed safe range or with a special token's string, and
    files of any other build, are encoded whole by the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        self.dtype = np.dtype("<u2") if self.lib.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.special = [t["content"] for t in conf.get("added_tokens") or []]
        self.kind = self._kind(conf)
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _kind(conf: dict) -> str:
        pre, norm = conf.get("pre_tokenizer") or {}, conf.get("normalizer")
        if conf["model"].get("type") != "BPE":
            return "whole"
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
            return "spaces kept"
        first = (pre.get("pretokenizers") or [{}])[0]
        steps = [n.get("type") for n in (norm or {}).get("normalizers", [])]
        if first.get("pattern", {}).get("Regex") == _WORD_END and first.get("invert") \
                and steps == ["NFC", "Replace", "Lowercase"]:
            return "spaces dropped"
        return "whole"

    def _parts(self, text: str) -> list[str] | None:
        if self.kind == "whole" or _UNUSUAL.search(text) or any(s in text for s in self.special):
            return None
        stops = _after_words(text, ".") and _after_words(text, ",")
        if self.kind == "spaces dropped":
            text = text.lower()
            return (text.replace(",", " ,").replace(".", " .") if stops else text).split()
        if any(x in text for x in _SPACES):
            return _PIECE.findall(text)
        # single spaces and line feeds only: a space goes with the part after it
        text = text.replace(" ", "\0 ").replace("\n", "\0\n\0")
        if stops:
            text = text.replace(",", "\0,").replace(".", "\0.")
        return text.split("\0")

    def _pack(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self._parts(t) for t in texts]
        known = self.known
        new = [p for p in set().union(*(c for c in cut if c)) if p not in known]
        full = len(known) >= CACHED_PIECES
        if new:
            fresh = self.lib.encode_batch_fast(new, add_special_tokens=False)
            known.update((p, self._pack(e.ids)) for p, e in zip(new, fresh))
        out = [np.array(self.lib.encode(t, add_special_tokens=False).ids, dtype=self.dtype) if c is None
               else np.frombuffer(b"".join(map(known.__getitem__, c)), dtype=self.dtype)
               for t, c in zip(texts, cut)]
        if full:  # pieces beyond the bound are known for these texts only
            for p in new:
                del known[p]
        return out


def _after_words(text: str, stop: str) -> bool:
    """Whether every ``stop`` follows a letter or digit."""
    before = "".join([p[-1:] or stop for p in text.split(stop)[:-1]])
    return not before or before.isalnum()


_PIECE = regex.compile(_BYTE_LEVEL)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file (kept between tasks)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def batches(texts, most_chars: int = 4_000_000):
    """Slices ``(from, to)`` of ``texts`` with about ``most_chars`` characters each."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= most_chars:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def crc32_of_ids(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    import zlib
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
