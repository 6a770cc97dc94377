"""Byte-level BPE in linear time: longest matches and backtracking.

A vocabulary is token bytes by rank. Bytes are mapped to Latin-1 letters, so an
Aho-Corasick automaton over text finds every token in a piece in one pass; the
longest one at each place is the first choice. Two neighbouring tokens are
compatible if the merges, run over their joined bytes, would leave the border
between them; this is told by undoing merges on both sides of it, and
remembered for each pair. A token that cannot follow its predecessor gives way
to its longest prefix that is a token; when none is left the predecessor is
taken back and its end is never tried again. So each place is left at most
once, and the tokens are exactly those of the merges.

Text is cut by the pattern of the vocabulary first; each worker remembers the
ids of pieces it has met, up to a bound (``pieces.PieceIds``).

Defined cases: a null or empty text has no ids and decodes to no bytes; texts
are read whole, a piece may be as long as the text; equal texts get equal
rows; ids outside the vocabulary are an error in ``decode``; special tokens do not
exist, their strings are plain text; other columns, whatever their names, are
not read; an empty table gives an empty one.
"""

import base64
import hashlib
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import chunks, table
from .pieces import BYTE_PATTERN, PieceIds, is_plain, ragged

#: Token pairs whose compatibility a worker remembers before it starts anew.
PAIRS = 1 << 20


class Vocabulary:
    """Tokens by rank; the rank is the id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.rank = ranks
        self.size = max(ranks.values()) + 1
        self.token = [b""] * self.size
        for t, i in ranks.items():
            self.token[i] = t
        self.length = [len(t) for t in self.token]
        self.automaton = ahocorasick.Automaton()
        for t, i in ranks.items():
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.shorter = [self.prefix(t) for t in self.token]
        #: The two tokens whose merge a token is; bytes, and tokens no merge reaches, are their own halves.
        self.left, self.right = list(range(self.size)), list(range(self.size))
        self.merged: dict[tuple[int, int], int] = {}
        self.remembered: dict[int, bool] = {}
        for i in sorted(ranks.values()):
            self.undo(i)
        self.remembered.clear()

    def prefix(self, token: bytes) -> int:
        """The longest token that is a proper prefix, or -1."""
        return next((r for n in range(len(token) - 1, 0, -1) if (r := self.rank.get(token[:n])) is not None), -1)

    def undo(self, token: int) -> None:
        """Finds the last merge of a token among its splits into earlier tokens."""
        whole, a = self.token[token], self.shorter[token]
        while a >= 0:
            b = self.rank.get(whole[self.length[a] :], self.size)
            if a < token and b < token and self.border_stays(a, b):
                self.left[token], self.right[token] = a, b
                self.merged[a, b] = token
                return
            a = self.shorter[a]

    def border_stays(self, a: int, b: int) -> bool:
        """Do the merges of the joined bytes of two tokens leave them as they are?

        Merges are undone from the latest on. If at some state the two tokens at
        the border have a merge that comes before the next one to be redone,
        the border would have been crossed. Of equal ranks the left one is done first.
        """
        before = self.size
        while True:
            if self.merged.get((a, b), self.size) < before:
                return False
            on_left = a > b
            for _ in range(2):
                if on_left and self.right[a] != a:
                    before, a = a, self.right[a]
                    break
                if not on_left and self.left[b] != b:
                    before, b = b + 1, self.left[b]
                    break
                on_left = not on_left
            else:
                return True

    def fits(self, a: int, b: int) -> bool:
        """``border_stays``, remembered for the next time."""
        if len(self.remembered) >= PAIRS:
            self.remembered.clear()
        known = self.remembered[a * self.size + b] = self.border_stays(a, b)
        return known

    def split(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        length, shorter, size, remembered, n = self.length, self.shorter, self.size, self.remembered.get, len(piece)
        longest = [0] * (n + 1)
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            # At a place, matches come in order of their ends: the longest is the last.
            longest[end + 1 - length[token]] = token
        closed: set[int] = set()
        out: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < n:
            end = at + length[token]
            if end not in closed and (last < 0 or (remembered(last * size + token) or remembered(last * size + token) is None and self.fits(last, token))):
                out.append(token)
                at, last, token = end, token, longest[end]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                closed.add(at)
                token = out.pop()
                last = out[-1] if out else -1
                at -= length[token]
        return out

    def split_all(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = [self.split(p.encode()) for p in pieces]
        n = np.array([len(e) for e in each], np.int64)
        return n, np.array([i for e in each for i in e], np.int32)


class Coder:
    """Pattern and vocabulary: whole texts to ids and back."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.vocabulary = Vocabulary(ranks)
        self.cut = regex.compile(pattern).findall
        from public_tokenizers import PATTERN

        #: The same pattern on text whose classes are plain, for the faster engine.
        self.cut_plain = BYTE_PATTERN.findall if pattern == PATTERN else self.cut
        self.known = PieceIds(self.vocabulary.split_all)
        self.bytes = table(self.vocabulary.token)
        self.digits = table([b"%d " % i for i in range(self.vocabulary.size)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each text, and the ids of all."""
        cut = [self.cut_plain(t) if is_plain(t) else self.cut(t) for t in texts]
        ids, n = self.known.ids([p for c in cut for p in c])
        ends = np.r_[0, np.cumsum(n)][np.cumsum([0] + [len(c) for c in cut])]
        return np.diff(ends), ids

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and how many each has."""
        return ragged(*self.bytes, ids)


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    """Built once in a worker."""
    return Coder(path, pattern)


def digests(flat: np.ndarray, ends: np.ndarray, drop: int = 0) -> list[str]:
    """SHA-256 of each slice up to an end, without its last ``drop`` bytes."""
    view, out, start = memoryview(flat.tobytes()), [], 0
    for end in ends.tolist():
        out.append(hashlib.sha256(view[start : max(start, end - drop)]).hexdigest())
        start = end
    return out


def encode_texts(docs: DataFrame, path: str, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256 and, if asked, ids."""
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    if pattern is None:
        from public_tokenizers import PATTERN as pattern

    def run(batches):
        c = coder(path, pattern)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for start, stop in chunks(texts):
                n, ids = c.encode(texts[start:stop])
                ends = np.r_[0, np.cumsum(n)]
                digits, dn = ragged(*c.digits, ids)
                raw, rn = c.decode(ids)
                one = digests(digits, np.r_[0, np.cumsum(dn)][ends[1:]], 1)
                two = digests(raw, np.r_[0, np.cumsum(rn)][ends[1:]])
                out = [b.column(0).slice(start, stop - start), pa.array(n), pa.array(one, pa.string()), pa.array(two, pa.string())]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(out, names)

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def decode_ids(rows: DataFrame, path: str, pattern: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and ``decoded``, the bytes of its ids; null ids decode to no bytes."""
    if pattern is None:
        from public_tokenizers import PATTERN as pattern

    def run(batches):
        c = coder(path, pattern)
        for b in batches:
            out = []
            for ids in b.column(1).to_pylist():
                raw, _ = c.decode(np.array(ids or [], np.int64))
                out.append(raw.tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], [id_col, "decoded"])

    ready = rows.select(F.col(id_col), F.col(ids_col).cast("array<int>").alias("__ids"))
    return ready.mapInArrow(run, f"`{id_col}` {ready.schema[0].dataType.simpleString()}, decoded binary")
