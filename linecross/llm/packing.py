"""Operator 9: token ids packed into rows of one length, as binary files.

Documents become ids with an end mark. One longer than a row is cut into full rows and a rest, so nothing is lost. The pieces of a
shard are placed by best-fit decreasing: longest first, each into the open row with the least room that still takes it. A segment
tree over room sizes finds that row: a node counts the open rows below it, and the search goes to the smallest room of at least
the wanted size.

A shard is what one task has read, up to ``shard_tokens``; packing needs no shuffle and a task holds one shard. Each shard gives
``<name>.ids`` (matrix of rows, little-endian unsigned 16-bit integers, or 32-bit for larger vocabularies), ``<name>.cu`` (unsigned
32-bit: for each row the count of its segments, then their cumulative lengths from 0) and ``<name>.pos`` (unsigned 64-bit: places in
the flat matrix at which positions start again from 0). Files are written whole under new names; the table names those that count.

Cases: null and empty texts are documents with the end mark alone; null ids are kept as null; repeated rows are packed each; an
empty table gives no shards.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame

from linecross.llm.common import write_file

SEGMENTS = "doc_id bigint, segment int, n_segments int, shard string, row int, start int, n_ids int"


class RoomTree:
    """Open rows by room: the least room of at least a size, in logarithmic time."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def take(self, wanted: int) -> tuple[int, int] | None:
        """A row with the least room that fits, and its room; it leaves the tree."""
        count, node = self.count, wanted + self.size
        if not count[node]:
            # Climb until a right sibling has rows, then go down to its leftmost leaf.
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.size
        self._change(room, -1)
        return self.rows[room].pop(), room

    def _change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1


def best_fit_decreasing(lengths: list[int], width: int) -> tuple[list[tuple[int, int]], int]:
    """Row and start of each piece (all of ``width`` at most), and the number of rows."""
    tree, used, placed = RoomTree(width), 0, [(0, 0)] * len(lengths)
    for piece in sorted(range(len(lengths)), key=lambda n: (-lengths[n], n)):
        found = tree.take(lengths[piece])
        if found is None:
            found, used = (used, width), used + 1
        row, room = found
        placed[piece] = (row, width - room)
        if room > lengths[piece]:
            tree.add(row, room - lengths[piece])
    return placed, used


@lru_cache(maxsize=2)
def byte_encoder(path: str, pattern: str):
    """A public byte-level vocabulary; every worker loads it once."""
    import tiktoken
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("linecross", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Shard:
    """Pieces of documents until they are packed and written."""

    def __init__(self, width: int, end: int, kind: str):
        self.width, self.end, self.kind = width, end, kind
        self.pieces: list[np.ndarray] = []
        self.owners: list[tuple[int | None, int, int]] = []
        self.tokens = 0

    def add(self, doc_id: int | None, ids: list[int]) -> None:
        all_ids = np.array([*ids, self.end], self.kind)
        parts = -(-len(all_ids) // self.width)
        for k in range(parts):
            self.pieces.append(all_ids[k * self.width:(k + 1) * self.width])
            self.owners.append((doc_id, k, parts))
        self.tokens += len(all_ids)

    def write(self, folder: str) -> pa.RecordBatch:
        name = f"{folder}/{uuid.uuid4().hex}"
        lengths = [len(p) for p in self.pieces]
        placed, rows = best_fit_decreasing(lengths, self.width)
        matrix = np.full((rows, self.width), self.end, self.kind)
        cuts: list[list[int]] = [[] for _ in range(rows)]
        for (row, start), piece in sorted(zip(placed, self.pieces), key=lambda x: x[0]):
            matrix[row, start:start + len(piece)] = piece
            cuts[row].append(start + len(piece))
        write_file(f"{name}.ids", matrix.tobytes())
        write_file(f"{name}.cu", np.concatenate([[len(c), 0, *c] for c in cuts]).astype("<u4").tobytes())
        resets = np.array([row * self.width + start for row, c in enumerate(cuts) for start in [0, *c[:-1]]], "<u8")
        write_file(f"{name}.pos", resets.tobytes())
        columns = list(zip(*((*owner, name, *place, n) for owner, place, n in zip(self.owners, placed, lengths))))
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          [part.split()[0] for part in SEGMENTS.split(", ")])


def pack_documents(docs: DataFrame, folder: str, vocabulary: str, pattern: str, width: int = 2048, end: int | None = None,
                   shard_tokens: int = 16_000_000) -> DataFrame:
    """Write packed shards below ``folder`` and return one row per segment: document, shard, row, start and length.

    The result must be written once (``stage``): each run of its plan writes shards of its own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(vocabulary, pattern)
        mark = encoder.n_vocab if end is None else end
        fresh = lambda: Shard(width, mark, "<u2" if max(mark, encoder.n_vocab) < 1 << 16 else "<u4")
        shard = fresh()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard.add(doc_id, encoder.encode_ordinary(text or ""))
                if shard.tokens >= shard_tokens:
                    yield shard.write(folder)
                    shard = fresh()
        if shard.tokens:
            yield shard.write(folder)

    return docs.select("doc_id", "text").mapInArrow(run, SEGMENTS)


def read_shard(name: str, width: int, kind: str = "<u2") -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Matrix, cumulative lengths of each row, and position resets."""
    def load(suffix: str, dtype: str) -> np.ndarray:
        store, path = fs.FileSystem.from_uri(f"{name}.{suffix}")
        with store.open_input_stream(path, compression=None) as file:
            return np.frombuffer(file.read(), dtype)
    flat, cuts, at = load("cu", "<u4"), [], 0
    while at < len(flat):
        cuts.append(flat[at + 1:at + 2 + flat[at]])
        at += 2 + int(flat[at])
    return load("ids", kind).reshape(-1, width), cuts, load("pos", "<u8")
