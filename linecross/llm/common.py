"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from linecross.staging import delete_path, discard, new_path, stage

__all__ = ["BUCKET_BITS", "block_values", "bucket_starts", "byte_slices", "crc_mod", "delete_path", "discard", "fold_ascii", "give_back", "join_files", "local_path", "map_batches", "mapped", "new_path", "per_shard",
           "places", "ranges", "read_table", "shard_blocks", "shared_folder", "stage", "words", "write_file"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Maximal runs outside ``[\\x20\\x09-\\x0D]``, as UTF-8: exactly what ``bytes.split`` parts at."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


#: Lower case for A-Z alone, as a table for ``bytes.translate``.
fold_ascii = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def crc_mod(column: str, modulus: int) -> str:
    """SQL for crc32 of a column as text, modulo; a null counts as the empty text."""
    return f"crc32(coalesce(cast({column} as string), '')) % {modulus}"


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.Table | pa.RecordBatch], schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with a function of one batch; empty batches are passed over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                yield from (out.to_batches() if isinstance(out, pa.Table) else [out])
        give_back()
    return df.mapInArrow(run, schema)


def byte_slices(batch: pa.RecordBatch, column: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of a text column each, and one row at least; nothing is copied."""
    if not batch.num_rows:
        return
    totals = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = totals[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(totals, before + size, "right")))
        yield batch.slice(first, end - first)
        first = end


def give_back() -> None:
    """Return freed memory to the machine. Workers serve one stage after the other and would keep the largest one's."""
    mapped.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new URI below the staging folder, for files that tasks write and read themselves."""
    uri = new_path(spark, label)
    return uri if urlparse(uri).scheme else f"file://{uri}"


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(start, start + length)``."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def local_path(uri: str) -> str | None:
    """The path of a ``file:`` URI or plain path, else None."""
    parsed = urlparse(uri)
    return parsed.path if parsed.scheme in ("", "file") else None


def write_file(uri: str, data: bytes | memoryview) -> None:
    """Write a whole file so that a retried task can repeat it: under another name first, then renamed."""
    from pyarrow import fs
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{os.getpid()}-{os.urandom(4).hex()}"
    with store.open_output_stream(part, compression=None) as out:
        out.write(data)
    store.move(part, path)


def join_files(uri: str, sources: list[str]) -> None:
    """One file with the bytes of others in a row, a few megabytes at a time; repeatable as ``write_file`` is."""
    from pyarrow import fs
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{os.getpid()}-{os.urandom(4).hex()}"
    with store.open_output_stream(part, compression=None) as out:
        for source in sources:
            with store.open_input_stream(fs.FileSystem.from_uri(source)[1], compression=None) as data:
                while piece := data.read(1 << 22):
                    out.write(piece)
    store.move(part, path)


@lru_cache(maxsize=4096)
def mapped(uri: str, dtype: str) -> np.ndarray:
    """A file as a memory-mapped array. Files of stores without paths are copied once per task, to a file that has no name."""
    path = local_path(uri)
    if path is not None:
        return np.asarray(np.memmap(path, dtype, "r")) if os.path.getsize(path) else np.empty(0, dtype)
    import tempfile
    store, path = fs.FileSystem.from_uri(uri)
    with tempfile.TemporaryFile() as copy, store.open_input_stream(path, compression=None) as source:
        while piece := source.read(1 << 22):
            copy.write(piece)
        return np.asarray(np.memmap(copy, dtype, "r")) if copy.tell() else np.empty(0, dtype)


#: Keys of a bucket on average, as a power of two.
BUCKET_BITS = 3


def bucket_starts(keys: np.ndarray) -> np.ndarray:
    """The first place of each range of 64-bit hashes in ascending keys; ranges are of equal width and hold a few keys each."""
    bits = max(1, len(keys).bit_length() - BUCKET_BITS)
    sizes = np.bincount((keys >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return (np.cumsum(sizes) - sizes).astype("<u4" if len(keys) < 1 << 32 else "<u8")


def places(table: np.ndarray, starts: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key in a table that is not empty, -1 for those it does not have.

    ``starts`` are the table's ``bucket_starts``. A binary search of a large file misses the caches at most of its steps; this does so once or twice.
    """
    bits, last = len(starts).bit_length() - 1, len(table) - 1
    at = np.minimum(starts[keys >> np.uint64(64 - bits)], last).astype(np.int64)
    todo = np.flatnonzero(table[at] < keys)
    while len(todo):
        todo = todo[at[todo] < last]
        at[todo] += 1
        todo = todo[table[at[todo]] < keys[todo]]
    at[table[at] != keys] = -1
    return at


def shard_blocks(shard: np.ndarray, keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """One row per shard from keys that are sorted within shards."""
    order = np.argsort(shard, kind="stable")
    shard, keys, values = shard[order], keys[order], values[order]
    cut = np.flatnonzero(np.diff(shard, prepend=-1))
    ends = np.append(cut[1:], len(shard))
    small = "<u4" if not len(values) or values.max() < 1 << 32 else "<u8"
    return pa.RecordBatch.from_arrays([pa.array(shard[cut].astype(np.int32)), pa.array([keys[x:y].tobytes() for x, y in zip(cut, ends)], pa.binary()),
                                       pa.array([values[x:y].astype(small).tobytes() for x, y in zip(cut, ends)], pa.binary())], ["shard", "a", "b"])


def block_values(raw: bytes, n: int) -> np.ndarray:
    """The values of a block of n."""
    return np.frombuffer(raw, "<u4" if len(raw) == 4 * n else "<u8").astype(np.int64)


def per_shard(blocks: DataFrame, shards: int, finish: Callable[[int, list[tuple[bytes, bytes]]], pa.RecordBatch | Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Bring the blocks of a shard together and finish each, with one batch or several."""
    def finished(number: int, parts: list[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        out = finish(number, parts)
        yield from [out] if isinstance(out, pa.RecordBatch) else out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts = None, []
        for batch in batches:
            for shard, a, b in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if shard != number and parts:
                    yield from finished(number, parts)
                    parts = []
                number = shard
                parts.append((a, b))
        if parts:
            yield from finished(number, parts)
        parts.clear()
        give_back()

    return blocks.repartition(max(1, shards), F.col("shard")).sortWithinPartitions("shard").mapInArrow(run, schema)


_RANDOM = np.random.default_rng(20240229)
_BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_POWER = np.uint64(0x9E3779B97F4A7C15)


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers that spreads every bit."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def hashed_words(texts: list[str | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, the same on every worker, and the number of words of each text."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(parts) + b"\n"
    codes = np.frombuffer(data.translate(fold_ascii) if lower else data, np.uint8)
    inside = ~_IS_SPACE[codes]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    lengths = ends - starts
    letters = np.flatnonzero(inside)
    first = np.cumsum(lengths) - lengths
    powers = np.full(int(lengths.max()), _POWER)
    powers[0] = 1
    with np.errstate(over="ignore"):
        powers = np.cumprod(powers)
        hashes = np.add.reduceat(_BYTE_VALUE[codes[letters]] * powers[np.arange(len(letters)) - np.repeat(first, lengths)], first)
    text_ends = np.cumsum([len(p) + 1 for p in parts])
    counts = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    return mix64(hashes), counts


def text_slices(texts: list[str | None], size: int = 1_000_000):
    """Ranges of rows of about ``size`` characters each; a longer text has a range of its own."""
    first, total = 0, 0
    for n, text in enumerate(texts):
        total += len(text or "")
        if total >= size:
            yield first, n + 1
            first, total = n + 1, 0
    if first < len(texts):
        yield first, len(texts)
