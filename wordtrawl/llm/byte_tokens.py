"""Byte-level BPE ids, equal to the ``tokenizers`` library with the same vocabulary, special strings included."""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import numpy as np
import tiktoken

#: Distinct stretches of text whose ids a worker remembers; then it starts anew.
REMEMBERED = 200_000
_SAFE = re.compile(r"(?<=\S) (?=\S)")


class ByteTokenizer:
    """Byte-level BPE of a rank file, with the ids of each distinct stretch between single blanks remembered.

    The pattern of pre-tokens never matches across a blank that stands between two visible characters, except as the first
    character of a match; so a text may be cut before each such blank. Strings in ``special`` have an id of their own, and the
    text between them is encoded piece by piece; where several match at one place the longest wins.
    """

    def __init__(self, ranks: bytes, pattern: str, special: tuple[tuple[str, int], ...] = ()):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.sizes = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            self.sizes[rank] = len(token)
        self.special = {text: np.array([number], "<u4").tobytes() for text, number in special}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if special else None
        self.known: dict[str, bytes] = {}

    def _plain(self, text: str) -> bytes:
        return np.array(self.library.encode_ordinary(text), "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Ids of all new stretches with one call: token sizes tell where each stretch ends."""
        ids = np.array(self.library.encode_ordinary(" " + " ".join(words)), "<u4")
        ends = np.cumsum([1 + len(w.encode()) for w in words])
        cuts = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1
        start = 0
        for word, cut in zip(words, cuts.tolist()):
            self.known[word] = ids[start:cut].tobytes()
            start = cut

    def _stretch(self, text: str) -> bytes:
        head, *words = text.split(" ")
        parts = list(map(self.known.get, words))
        if None in parts or not head or head[-1].isspace():
            missing = {w for w, p in zip(words, parts) if p is None}
            if not head or head[-1].isspace() or any(not w or w[0].isspace() or w[-1].isspace() for w in missing):
                stretches = _SAFE.split(text)
                return self._plain(stretches[0]) + b"".join(self._plain(" " + s) for s in stretches[1:])
            if len(self.known) + len(missing) > REMEMBERED:
                self.known.clear()
                missing = set(words)
            self._learn(list(missing))
            parts = list(map(self.known.__getitem__, words))
        return self._plain(head) + b"".join(parts)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.cut is None or not any(s in text for s in self.special):
            return self._stretch(text)
        return b"".join(self.special[s] if s in self.special else self._stretch(s) for s in self.cut.split(text) if s)


@lru_cache(maxsize=2)
def tokenizer(ranks: bytes, pattern: str, special: tuple[tuple[str, int], ...] = ()) -> ByteTokenizer:
    return ByteTokenizer(ranks, pattern, special)


def read_ranks(path: str) -> bytes:
    """The rank file's bytes; they travel with the tasks, so that only the driver needs the file."""
    with open(path, "rb") as file:
        return file.read()


def read_special(path: str) -> tuple[tuple[str, int], ...]:
    """(text, id) of the special strings that a ``tokenizers`` file names.

    Only strings matched literally are supported, and a file with others is refused.
    """
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    for token in added:
        if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
            raise ValueError(f"special string {token['content']!r} is not matched literally")
    return tuple((token["content"], token["id"]) for token in added)
