"""Cached ids of the word-ended BPE tokenizer (``word_bpe_49k.json``).

No token spans white space, so a text's ids are its white-space runs' ids one
after another. Runs repeat, so each worker keeps their ids; the model itself only
sees words it hasn't met. Anything but printable ASCII and precomposed Latin
letters, or what may hold a special token, goes through the library's full path, and
so does every text of a file whose normaliser or split isn't the one this rests on.
"""

from __future__ import annotations

import array
import functools
import json
import os
import re

import numpy as np

_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPACE = re.compile("[\t\n\x0b\x0c\r ]+")
_SIMPLE = re.compile("[!-~À-įı-ſ]+")
_LETTERS = "a-zÀ-ÖØ-öø-ſ"
#: The tokenizer file's own split pattern, narrowed to the characters of ``_SIMPLE``.
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")
#: The normaliser and split of the files that the short path holds for.
_NORMALIZERS = ["NFC", ("Replace", r"\s+", " "), "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_MARKS = frozenset(".,;:!?")
_CACHE_LIMIT = 300_000


def _byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, others from U+0100 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTE = _byte_chars()


class _Kept(dict):
    """A bounded cache in two generations: what is used again moves to the young one."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def short_path(tokenizer: str) -> bool:
    """Whether a tokenizer's JSON is of the kind that ids by word are right for."""
    parts = json.loads(tokenizer)
    norm, pre, model = parts.get("normalizer") or {}, parts.get("pre_tokenizer") or {}, parts["model"]
    steps = [(n["type"], n["pattern"].get("Regex"), n["content"]) if n["type"] == "Replace" else n["type"]
             for n in norm.get("normalizers", [])]
    split, level = (pre.get("pretokenizers", []) + [{}, {}])[:2]
    return (steps == _NORMALIZERS and len(pre.get("pretokenizers", [])) == 2
            and split.get("type") == "Split" and split["pattern"].get("Regex") == _SPLIT
            and split["behavior"] == "Removed" and split["invert"] is True
            and level.get("type") == "ByteLevel" and not level["add_prefix_space"] and not level["use_regex"]
            and model["type"] == "BPE" and not model.get("dropout")
            and not parts.get("truncation") and not parts.get("padding")
            and all(t["content"].startswith("<|") for t in parts.get("added_tokens", [])))


class WordTokenizer:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.short = short_path(self.tok.to_str())
        self.runs = _Kept(self._run, _CACHE_LIMIT)
        self.words = _Kept(self._word, _CACHE_LIMIT)

    def encode(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit integers."""
        if not self.short:
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4")
        if "<|" not in text and "Σ" not in text:     # lower-casing by run or at once is the same
            text = text.lower()
        parts = _SPACE.split(text) if _ODD_SPACE.search(text) else text.split()
        return np.frombuffer(b"".join(map(self.runs.__getitem__, parts)), dtype="<u4")

    def _run(self, run: str) -> bytes:
        word, mark = (run[:-1], run[-1]) if run[-1:] in _MARKS else (run, "")
        if word.isascii() and word.isalpha():        # the usual run: a word and one mark at most
            return self.words[word.lower()] + (self.words[mark] if mark else b"")
        if not run:
            return b""
        if not _SIMPLE.fullmatch(run) or "<|" in run:
            return array.array("I", self.tok.encode(run, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.words.__getitem__, _WORDS.findall(run.lower())))

    def _word(self, word: str) -> bytes:
        chars = word if word.isascii() else "".join(_BYTE[b] for b in word.encode())
        return array.array("I", [t.id for t in self.model.tokenize(chars)]).tobytes()


@functools.lru_cache(2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)
