"""Text cut as a tokenizer cuts it, and the ids of pieces that a worker has met.

A corpus repeats its words: each worker keeps the ids of the pieces it met, up
to a bound after which it starts anew, so the merges run once for a word.
"""

import json
import re
import unicodedata
from itertools import repeat

import numpy as np

#: Characters whose class, case and composition are the same in every Unicode version.
PLAIN_END = 0x300
NOT_PLAIN = re.compile(
    "[^" + "".join(re.escape(chr(c)) for c in range(PLAIN_END) if len(chr(c).lower()) == 1 and ord(chr(c).lower()) < PLAIN_END) + "]"
)


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(PLAIN_END) if unicodedata.category(chr(c))[0] == kind)


LETTER, NUMBER = _class("L"), _class("N")
#: White space as Unicode lists it; Python's own \s adds four separators.
BLANK = "\\t-\\r \x85\xa0"
SUFFIX = "'(?:s|t|re|ve|m|ll|d)"
#: Split pattern of the word tokenizer, on lower-case plain text.
WORD_PATTERN = re.compile(f"[{LETTER}]+|{SUFFIX}|[{NUMBER}]|[^{BLANK}{LETTER}{NUMBER}]+")
#: Split pattern of the byte tokenizer, on plain text.
BYTE_PATTERN = re.compile(
    f" ?[{LETTER}]+|{SUFFIX}| ?[{NUMBER}]+| ?[^{BLANK}{LETTER}{NUMBER}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
)


def special_tokens(path: str) -> dict[str, int]:
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def is_plain(text: str) -> bool:
    return text.isascii() or NOT_PLAIN.search(text) is None


def ragged(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a ragged array, one after another, and the length of each."""
    n = lens[rows]
    ends = np.cumsum(n, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total, dtype=np.int64) + np.repeat(starts[rows] - (ends - n), n)
    return flat[at], n


class PieceIds:
    """Ids of distinct pieces; ``encode`` maps a list of pieces to (lengths, ids)."""

    def __init__(self, encode, limit: int = 600_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.lens = np.empty(0, np.int64)
        self.used = 0

    def _add(self, new: list[str]) -> None:
        lens, ids = self.encode(new)
        lens = np.asarray(lens, np.int64)
        n, need = len(self.row), self.used + len(ids)
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.empty(need, np.int32)])
        if n + len(new) > len(self.lens):
            room = np.zeros(n + 2 * len(new), np.int64)
            self.starts = np.concatenate([self.starts[:n], room])
            self.lens = np.concatenate([self.lens[:n], room])
        self.flat[self.used : need] = ids
        self.lens[n : n + len(new)] = lens
        self.starts[n : n + len(new)] = self.used + np.cumsum(lens) - lens
        self.row.update(zip(new, range(n, n + len(new))))
        self.used = need

    def ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in order, and how many each piece has."""
        rows = self._rows(pieces)
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            new = list(dict.fromkeys(pieces[i] for i in missing))
            if len(self.row) + len(new) > self.limit:
                self.clear()
                new, missing = list(dict.fromkeys(pieces)), np.arange(len(pieces))
            self._add(new)
            rows[missing] = self._rows([pieces[i] for i in missing])
        return ragged(self.flat, self.starts, self.lens, rows)

    def _rows(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.row.get, pieces, repeat(-1)), np.int64, len(pieces))
