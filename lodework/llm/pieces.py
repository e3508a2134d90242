"""Encoding of text pieces with a tokenizer file of the ``tokenizers`` library, remembered per Python worker.

A *piece* is what the tokenizer's own rules never join with its neighbours. Where a piece
ends depends on the file:

* ``dropped``: white space is dropped and words are split before the merges, so every
  blank and line feed separates pieces;
* ``leading``: byte-level rules attach one blank to the word behind it, so a blank
  between two other characters separates pieces, and belongs to the second;
* any other file: the whole text is one piece.
"""

from __future__ import annotations

import json
import os
import re
from array import array

# One thread per task: Spark shares out the cores.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces remembered per worker and generation; older ones are forgotten, never lost from results.
REMEMBERED_PIECES = 150_000
LONGEST_REMEMBERED = 64


class Remembered(dict):
    """A dictionary of bounded size that makes missing values; two generations, so frequent keys survive."""

    def __init__(self, make, size: int):
        super().__init__()
        self._make, self._size, self._old = make, size, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        if len(key) > LONGEST_REMEMBERED:
            return value
        if len(self) >= self._size:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value


def mode(rules: dict) -> str:
    before = rules.get("pre_tokenizer") or {}
    steps = before.get("pretokenizers", [before])
    first = steps[0] if steps else {}
    added = "".join(t["content"] for t in rules.get("added_tokens", []))
    plain = not any(t[k] for t in rules.get("added_tokens", []) for k in ("lstrip", "rstrip")) and not added.count(" ")
    normal = rules.get("normalizer") or {}
    kinds = {n.get("type") for n in normal.get("normalizers", [normal])} - {None}
    if plain and kinds <= {"NFC", "Replace", "Lowercase"} and first.get("type") == "Split" and first.get("invert") \
            and first.get("behavior") == "Removed":
        return "dropped"
    if plain and not kinds and first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space"):
        return "leading"
    return "whole"


def byte_letters() -> dict[str, int]:
    """Byte of each letter of the byte-level alphabet: printable bytes stand for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


# Fixed value: the pattern of byte-level tokenizers.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Merges:
    """The merges of a byte-level BPE file run by ``tiktoken``, which takes a word's bytes and ranks.

    An end-of-word suffix becomes the byte 0xFF, which UTF-8 never holds; it joins the last
    byte before any other merge. ``usable`` only if the file's ids follow the order of its merges.
    """

    END = b"\xff"

    def __init__(self, rules: dict):
        model, letters = rules["model"], byte_letters()
        suffix = model.get("end_of_word_suffix") or ""
        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.usable, self._core = False, None

        def raw(token: str) -> bytes | None:
            end = bool(suffix) and token.endswith(suffix)
            stem = token[:-len(suffix)] if end else token
            return bytes(letters[c] for c in stem) + self.END * end if all(c in letters for c in stem) else None

        made = ["".join(m) for m in merges]
        single = sorted((vocab[t], t) for t in vocab if len(raw(t) or b"") == 1 or len(raw(t) or b"") == 2 and suffix and t.endswith(suffix))
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        order = [vocab.get(t, -1) for t in made]
        base = [i for i, t in single if t not in set(made)]
        if not plain or order != sorted(set(order)) or not base or max(base) > order[0] or len(base) != (512 if suffix else 256):
            return
        if suffix and max(vocab[t] for _, t in single if t in vocab and not t.endswith(suffix)) > min(
                vocab[t] for _, t in single if t.endswith(suffix)):
            return
        import tiktoken

        ranks = {r: i for t, i in vocab.items() if (r := raw(t)) is not None and (i in set(base) or i >= order[0])}
        if len(ranks) != len(base) + len(order):
            return
        whole = tiktoken.Encoding("merges", pat_str=_BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        self.usable, self._ending, self._one = True, self.END if suffix else b"", whole._core_bpe.encode_single_piece
        self.text_ids = whole.encode_to_numpy

    def ids(self, word: bytes) -> list[int]:
        return self._one(word + self._ending)


# Words whose normal form and parts are the same under every version of Unicode: ASCII and the
# accented letters of Latin-1. Others go to the library.
_SIMPLE = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u00ff0-9]+")
_BYTE_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+| ?[0-9]+"
                         "| ?[^ A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff0-9]+")
# Runs of white space on which a pattern that looks ahead gives up: the library takes such texts.
_LONG_SPACE = re.compile(r"\s{10000}")
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


class Pieces:
    """Ids of pieces as little-endian 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        self.path, self.mode = path, mode(rules)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._added = [t["content"] for t in rules.get("added_tokens", [])]
        split = ((rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex")
        self._merges = Merges(rules) if self.mode == "leading" or self.mode == "dropped" and split == _SPLIT else None
        self._lower = self.mode == "dropped" and "Lowercase" in str(rules.get("normalizer"))
        if self._merges and (not self._merges.usable or self.mode == "dropped" and not self._lower):
            self._merges = None
        self.words = Remembered(self.piece, REMEMBERED_PIECES)
        self.blank_words = Remembered(lambda w: self.piece(b" " + w), REMEMBERED_PIECES)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self._tokens = [self.tokenizer.id_to_token(i) for i in range(size)]

    def whole(self, text: bytes) -> bytes:
        """Ids by the library."""
        if not text:
            return b""
        return array("I", self.tokenizer.encode(text.decode(), add_special_tokens=False).ids).tobytes()

    def piece(self, word: bytes) -> bytes:
        """Ids of one piece: simple words by their merges, others by the library."""
        if self._merges is not None and word.removeprefix(b" ").isalpha():  # ASCII letters only: one part
            return array("I", self._merges.ids(word.lower() if self._lower else word)).tobytes()
        text = word.decode()
        if self._merges is None or not _SIMPLE.fullmatch(text.removeprefix(" ")) or any(a in text for a in self._added):
            return self.whole(word)
        parts = _PARTS.findall(text.lower()) if self._lower else _BYTE_PARTS.findall(text)
        ids = array("I")
        for part in parts:
            ids.extend(self._merges.ids(part.encode()))
        return ids.tobytes()

    def text_ids(self, text: str) -> bytes:
        """Ids of a whole text, by the merges where they do what the library does."""
        if self.mode == "leading" and self._merges is not None and not any(a in text for a in self._added) \
                and not _LONG_SPACE.search(text):
            return self._merges.text_ids(text).astype("<u4", copy=False).tobytes()
        return self.encode(text.encode())

    @staticmethod
    def separable(text: str) -> bool:
        """Whether each blank of the text stands between two characters that are not white space."""
        return " ".join(text.split()) == text.replace("\n", " ")

    def encode(self, text: bytes) -> bytes:
        """Ids of a whole text, from its pieces."""
        if self.mode == "dropped":
            return b"".join(map(self.words.__getitem__, text.replace(b"\n", b" ").split(b" ")))
        if self.mode == "leading" and text and self.separable(text.decode()):
            first, *rest = text.split(b" ")
            return self.words[first] + b"".join(map(self.blank_words.__getitem__, rest))
        return self.whole(text)

    def decode(self, ids: list[int]) -> str:
        """As the library's ``decode`` with special tokens kept."""
        if self.tokenizer.decoder is not None:
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        if ids and (max(ids) >= len(self._tokens) or min(ids) < 0):
            ids = [i for i in ids if 0 <= i < len(self._tokens)]
        return " ".join([t for t in map(self._tokens.__getitem__, ids) if t is not None])


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The tokenizer of ``path``, loaded once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]
