"""Operator 8: byte-pair encoding by a segment tree over the ranks of adjacent pairs, and decoding.

The vocabulary file's own steps are followed: special tokens are cut out of the raw text, the rest goes through NFC, white space
to one space, lower case per code point, the file's split into words, and the byte alphabet with a word end. A word's merges come
from a segment tree whose leaf *i* holds ``rank * leaves + i`` of the pair that starts at symbol *i*. The root is therefore the
leftmost pair of lowest rank; a merge changes three leaves and their ancestors. Many short words go through one tree array at a
time (one row per word); a long word has a tree of its own.

Cases: a null text is an empty one; an empty text has no ids and decodes to an empty text; texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from linecross.llm.common import byte_slices, give_back, map_batches

#: Chunks of text whose ids a worker remembers at most. A full memory starts anew, so that it stays bounded.
CACHE_CHUNKS = 400_000
#: Words of up to this many symbols share tree arrays.
SHARED_TREE = 64
_NONE = np.int64(2**62)


def _byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 stands for itself, the others follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return [chr(b if b in set(own) else 256 + rest.index(b)) for b in range(256)]


def _class_of(*categories: str) -> str:
    """The inside of a character class with all code points of the categories, as ranges."""
    inside, start = [], None
    for c in range(sys.maxunicode + 2):
        member = c <= sys.maxunicode and unicodedata.category(chr(c))[0] in categories
        if member and start is None:
            start = c
        elif not member and start is not None:
            inside.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(inside)


#: Unicode's White_Space. Python's own ``\s`` adds the separators 1C-1F.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"


class SegmentTree:
    """Minimum over leaves with logarithmic point updates."""

    def __init__(self, leaves: list[int]):
        self.size = 1 << max(0, len(leaves) - 1).bit_length()
        tree = [int(_NONE)] * self.size + leaves + [int(_NONE)] * (self.size - len(leaves))
        for i in range(self.size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        self.tree = tree

    def root(self) -> int:
        return self.tree[1]

    def put(self, leaf: int, value: int) -> None:
        tree, i = self.tree, leaf + self.size
        tree[i] = value
        while i > 1:
            i >>= 1
            new = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == new:
                break
            tree[i] = new


class Bpe:
    """Encoder and decoder for a vocabulary file of the ``tokenizers`` library (BPE with word ends and a byte alphabet)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocab, merges = data["model"]["vocab"], data["model"]["merges"]
        suffix = data["model"]["end_of_word_suffix"] or ""
        self.specials = {t["content"]: t["id"] for t in data["added_tokens"]}
        tokens = dict(sorted((i, t) for t, i in {**vocab, **self.specials}.items()))
        self.tokens = [tokens.get(i, "") for i in range(max(tokens) + 1)]
        self.base = np.int64(len(self.tokens))
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([vocab[a] * int(self.base) + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = np.append(keys[order], _NONE), np.append(order, -1)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.by_pair = dict(zip(keys.tolist(), range(len(pairs))))
        alphabet = _byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int64)
        self.final = np.array([vocab[c + suffix] for c in alphabet], np.int64)
        letters, numbers = _class_of("L"), _class_of("N")
        self.word = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{_SPACE}{letters}{numbers}]+")
        self.chunk = re.compile(f"[^{_SPACE}]+")
        self.odd_space = re.compile("[\x1c-\x1f]")
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        self.cache: dict[str, bytes] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for one that never merges."""
        key = left * self.base + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def _long(self, symbols: list[int]) -> list[int]:
        """One word through its own tree."""
        n, base, rank = len(symbols), int(self.base), self.by_pair
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        width = 1 << max(0, n - 1).bit_length()

        def leaf(i: int) -> int:
            if i < 0 or after[i] >= n:
                return int(_NONE)
            r = rank.get(symbols[i] * base + symbols[after[i]])
            return int(_NONE) if r is None else r * width + i

        tree = SegmentTree([leaf(i) for i in range(n)])
        while (root := tree.root()) < _NONE:
            r, i = divmod(root, width)
            j = after[i]
            symbols[i], after[i] = int(self.merged[r]), after[j]
            if after[j] < n:
                before[after[j]] = i
            tree.put(j, int(_NONE))
            tree.put(i, leaf(i))
            if before[i] >= 0:
                tree.put(before[i], leaf(before[i]))
            symbols[j] = -1
        return [s for s in symbols if s >= 0]

    def _short(self, symbols: np.ndarray, width: int) -> np.ndarray:
        """Words of up to ``width`` symbols, one per row and filled up with -1; the result has -1 where symbols went into others."""
        k = len(symbols)
        symbols = np.concatenate([symbols, np.full((k, 1), -1)], axis=1)
        place = np.arange(width)
        after, before = np.tile(place + 1, (k, 1)), np.tile(np.append(place - 1, width - 1), (k, 1))
        rank = self._rank(symbols[:, :-1], symbols[:, 1:])
        tree = np.full((k, 2 * width), _NONE)
        tree[:, width:] = np.where((rank >= 0) & (symbols[:, 1:] >= 0), rank * width + place, _NONE)
        for i in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1], out=tree[:, i])
        flat = tree.reshape(-1)

        def put(rows: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
            start, i = rows * (2 * width), leaf + width
            flat[start + i] = value
            while i[0] > 1:
                i = i >> 1
                flat[start + i] = np.minimum(flat[start + 2 * i], flat[start + 2 * i + 1])

        def value(rows: np.ndarray, i: np.ndarray) -> np.ndarray:
            right = symbols[rows, after[rows, i]]
            rank = self._rank(symbols[rows, i], right)
            return np.where((rank >= 0) & (right >= 0), rank * width + i, _NONE)

        rows = np.flatnonzero(tree[:, 1] < _NONE)
        while len(rows):
            root = tree[rows, 1]
            i = root % width
            j = after[rows, i]
            symbols[rows, i] = self.merged[root // width]
            k2 = after[rows, j]
            after[rows, i] = k2
            before[rows, k2] = i
            symbols[rows, j] = -1
            put(rows, j, np.full(len(rows), _NONE))
            put(rows, i, value(rows, i))
            has = before[rows, i] >= 0
            left = before[rows[has], i[has]]
            if len(left):
                put(rows[has], left, value(rows[has], left))
            rows = rows[tree[rows, 1] < _NONE]
        return symbols[:, :-1]

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words that are already normalised and split."""
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(words)
        groups: dict[int, list[int]] = {}
        for n, word in enumerate(words):
            if len(word) > SHARED_TREE:
                symbols = self.inner[np.frombuffer(word, np.uint8)]
                symbols[-1] = self.final[word[-1]]
                out[n] = np.array(self._long(symbols.tolist()), np.uint32)
            else:
                groups.setdefault(max(2, 1 << (len(word) - 1).bit_length()), []).append(n)
        for width, members in groups.items():
            for first in range(0, len(members), 20_000):
                part = members[first:first + 20_000]
                sizes = np.array([len(words[n]) for n in part])
                raw = np.frombuffer(b"".join(words[n].ljust(width, b"\0") for n in part), np.uint8).reshape(len(part), width)
                symbols = self.inner[raw]
                rows = np.arange(len(part))
                symbols[rows, sizes - 1] = self.final[raw[rows, sizes - 1]]
                symbols[np.arange(width) >= sizes[:, None]] = -1
                done = self._short(symbols, width)
                left = done >= 0
                ids, ends = done[left].astype("<u4"), np.cumsum(left.sum(axis=1))
                for n, a, b in zip(part, [0, *ends[:-1].tolist()], ends.tolist()):
                    out[n] = ids[a:b]
        return out

    def _learn(self, chunks: list[str]) -> None:
        """Put the ids of chunks without white space into the memory."""
        parts, counts = [], []
        for chunk in chunks:
            found = self.word.findall(chunk)
            parts += [w.encode("utf-8", "surrogatepass") for w in found]
            counts.append(len(found))
        ids, at = self.encode_words(parts), 0
        for chunk, count in zip(chunks, counts):
            self.cache[chunk] = b"".join(x.tobytes() for x in ids[at:at + count])
            at += count

    def _chunks(self, text: str) -> list[str]:
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # Lower case without the context rule for the final sigma.
        text = text.replace("Σ", "σ").lower()
        return self.chunk.findall(text) if self.odd_space.search(text) else text.split()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        pieces: list[list[bytes | list[str]]] = []
        for text in texts:
            own: list[bytes | list[str]] = []
            for piece in self.special.split(text or "") if self.specials and text and "<|" in text else [text or ""]:
                own.append(self.specials[piece].to_bytes(4, "little") if piece in self.specials else self._chunks(piece))
            pieces.append(own)
        wanted = {chunk for own in pieces for piece in own if not isinstance(piece, bytes) for chunk in piece}
        if new := wanted.difference(self.cache):
            if len(self.cache) + len(new) > CACHE_CHUNKS:
                self.cache.clear()
                new = wanted
            self._learn(list(new))
        get = self.cache.__getitem__
        return [b"".join(p if isinstance(p, bytes) else b"".join(map(get, p)) for p in own) for own in pieces]

    def decode(self, ids: bytes) -> str:
        """The tokens of ids, special ones too, with one space between: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """One encoder per worker and file."""
    return Bpe(path)


def bpe_encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """All rows and columns, and an array column of token ids; ``decoded`` also names a column with the text made from the ids.

    Columns of the same names are replaced. ``vocabulary`` is a path that every executor has. Tasks hold the words and ids of about a
    megabyte of text, or of one longer text.
    """
    names = [c for c in docs.columns if c not in (ids, decoded)]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names), f"`{ids}` array<bigint>",
                        *([f"`{decoded}` string"] if decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            for part in byte_slices(batch, text):
                coded = bpe.encode(part.column(text).to_pylist())
                sizes = np.array([len(x) // 4 for x in coded])
                flat = pa.array(np.frombuffer(b"".join(coded), "<u4").astype(np.int64))
                columns = [part.column(c) for c in names] + [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), flat)]
                if decoded:
                    columns.append(pa.array(map(bpe.decode, coded), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*names, ids, *([decoded] if decoded else [])])
        give_back()

    return (docs.select(*{*names, text}) if text in names else docs).mapInArrow(run, schema)


def bpe_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids, and SHA-256 of the text decoded from them.

    The same encoder and decoder as ``bpe_encode``; the ids stay in the task, as only digests are asked for.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(vocabulary)
        counts, ids, decoded = [], [], []
        texts = batch.column("text")
        for first in range(0, batch.num_rows, 512):
            for coded in bpe.encode(texts.slice(first, 512).to_pylist()):
                counts.append(len(coded) // 4)
                ids.append(hashlib.sha256(coded).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(coded).encode("utf-8", "surrogatepass")).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)],
                                          ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
