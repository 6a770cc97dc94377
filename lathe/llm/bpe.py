"""Byte-level BPE encoding and decoding of whole texts.

Encoding merges many words at once: the symbols of all words lie in one flat
array, the pairs of neighbours are looked up by binary search over the sorted
pair keys, and each round merges the pair of lowest rank in every word. Words
without a known pair leave the rounds. Decoding and the digests are gathers
from tables of token bytes.

Defined cases: a null or empty text has no ids and decodes to an empty text;
a text of any length is read whole; equal texts get equal rows; added tokens
written in a text are recognised as the tokenizer recognises them; other
columns of the input, whatever their names, are not read.
"""

import hashlib
import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import BYTE_PATTERN, PieceIds, is_plain, ragged, special_tokens

NONE = np.iinfo(np.int32).max
#: Characters of texts that are worked on together in a task.
CHUNK = 2_000_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


class Codec:
    """Vocabulary and merges of a byte-level BPE file as arrays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.special = special_tokens(path)
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.size = size
        self.of_byte = np.array([vocab[c] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * size + right
        self.rank = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.rank]
        tokens = [b""] * size
        for t, i in vocab.items():
            tokens[i] = bytes(byte_of[c] for c in t)
        for t, i in self.special.items():
            tokens[i] = t.encode()
        self.bytes = table(tokens)
        self.digits = table([b"%d," % i for i in range(size)])
        self.known = PieceIds(self.piece_ids)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every word: merge rounds over all words together."""
        raw = [w.encode() for w in words]
        lens = np.array([len(b) for b in raw], np.int64)
        syms = self.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        word = np.repeat(np.arange(len(raw)), lens)
        done_syms, done_word = [], []
        while len(syms):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            key = syms[:-1] * self.size + syms[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (word[1:] == word[:-1])
            rank = np.r_[np.where(known, self.rank[at], NONE), NONE]
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(syms)]))
            over = best == NONE
            if over.any():
                done_syms.append(syms[over])
                done_word.append(word[over])
            hit = (rank == best) & ~over
            # Of a run of overlapping equal pairs every second one is merged, from the left.
            place = np.arange(len(hit))
            first = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, 0))
            hit &= (place - first) % 2 == 0
            syms = np.where(hit, self.merged[np.where(hit, rank, 0)], syms)
            stay = ~over & ~np.r_[False, hit[:-1]]
            syms, word = syms[stay], word[stay]
        if not done_word:
            return np.zeros(len(words), np.int64), np.empty(0, np.int32)
        word = np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return np.bincount(word, minlength=len(words)), np.concatenate(done_syms)[order].astype(np.int32)

    def pieces(self, text: str) -> list[str]:
        """Pieces that are merged apart from each other; added tokens stay whole."""
        out: list[str] = []
        parts = self.at_special.split(text) if any(t in text for t in self.special) else [text]
        for p in parts:
            if p in self.special:
                out.append(p)
            elif is_plain(p):
                out += BYTE_PATTERN.findall(p)
            else:
                out += [p[a:b] for _, (a, b) in self.cut(p)]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.pieces(t) for t in texts]
        flat = [p for c in cut for p in c]
        if not flat:
            return [np.empty(0, np.int32) for _ in texts]
        ids, n = self.known.ids(flat)
        ends = np.r_[0, np.cumsum(n)][np.cumsum([len(c) for c in cut])]
        return np.split(ids, ends[:-1])

    def piece_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = [w for w in words if w not in self.special]
        lens, ids = self.merge(plain)
        if len(plain) == len(words):
            return lens, ids
        merged = iter(np.split(ids, np.cumsum(lens)[:-1]) if plain else [])
        each = [np.array([self.special[w]], np.int32) if w in self.special else next(merged) for w in words]
        return np.array([len(e) for e in each]), np.concatenate(each)

    def decode_bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return ragged(*self.bytes, ids)


def table(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lens = np.array([len(v) for v in values], np.int64)
    return np.frombuffer(b"".join(values), np.uint8), np.cumsum(lens) - lens, lens


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """Loaded once in a worker."""
    return Codec(path)


def utf8(raw: memoryview) -> bytes:
    """Decoded text in UTF-8; broken sequences become U+FFFD."""
    b = bytes(raw)
    try:
        b.decode()
    except UnicodeDecodeError:
        return b.decode(errors="replace").encode()
    return b


def chunks(texts: list[str], size: int = CHUNK):
    """Slices of a batch of about ``size`` characters, one text at least."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256 and, if asked, ids."""
    fields = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches):
        c = codec(path)
        for batch in batches:
            keys, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks(texts):
                each = c.encode(texts[a:b])
                n = np.array([len(e) for e in each], np.int64)
                ids = np.concatenate(each)
                ends = np.cumsum(n)
                digits, dn = ragged(*c.digits, ids)
                raw, rn = c.decode_bytes(ids)
                dn, rn = np.r_[0, np.cumsum(dn)], np.r_[0, np.cumsum(rn)]
                digits, raw = memoryview(digits.tobytes()), memoryview(raw.tobytes())
                one, two = [], []
                for e, k in zip(ends, n):
                    d0, d1, r0, r1 = dn[e - k], dn[e], rn[e - k], rn[e]
                    one.append(hashlib.sha256(digits[d0 : max(d0, d1 - 1)]).hexdigest())
                    two.append(hashlib.sha256(utf8(raw[r0:r1])).hexdigest())
                out = [keys.slice(a, b - a), pa.array(n), pa.array(one, pa.string()), pa.array(two, pa.string())]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(out, names)

    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, fields + ", ids array<int>" * with_ids)
