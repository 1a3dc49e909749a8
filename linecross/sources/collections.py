"""GeoJSON feature collections read by byte ranges, so that one file of any size keeps many tasks busy.

A range can begin anywhere, also inside a string. What it must know of the bytes before it adds up: whether the unescaped quotes are odd
(it begins inside a string), and how many brackets are open. A first pass counts both per range, the brackets for either case; running
sums over the ranges of a file give every range its start. In the second pass a range yields the features that open in it, the last one
read to its end beyond the range. Neither the order of members nor line breaks nor features nested in properties matter.

Objects of a member's array without ``"type": "Feature"`` are foreign and left out; a file that ends inside a feature and text that is no
JSON raise an error. Files that pyarrow opens compressed (``.gz``, ``.bz2``, ``.zst``) cannot be entered midway and are one range each.
Executors open files through ``pyarrow.fs``, so a store must be known to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Bytes of a range; ``read_layer`` callers with many small files get one range per file.
RANGE_BYTES = 32 << 20
_BLOCK = 1 << 20
_BATCH_BYTES = 4 << 20
_COMPRESSED = r"\.(gz|bz2|zst|lz4|br)$"
_WHOLE = 1 << 62
_QUOTE, _BACKSLASH, _OPEN, _CLOSE, _COLON = (ord(c) for c in '"\\{}:')
_MARKS = np.isin(np.arange(256), list(b'"{}[]'))
_STEP = np.array([1 if c in b"{[" else -1 if c in b"}]" else 0 for c in range(256)])
_SPACE = b" \t\r\n"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _blocks(path: str, start: int, end: int) -> Iterator[bytes]:
    """Blocks from ``start``; they go on beyond ``end`` for as long as the caller asks."""
    store, name = _store(path)
    if end == _WHOLE:
        with store.open_input_stream(name) as source:
            while block := source.read(_BLOCK):
                yield block
        return
    with store.open_input_file(name) as source:
        source.seek(start)
        # a block never crosses the range's end, so that counts stop there
        while block := source.read(min(_BLOCK, end - start) if start < end else _BLOCK):
            start += len(block)
            yield block


def _before(path: str, start: int) -> tuple[int, int]:
    """Length of the run of backslashes that ends at ``start``, and the last byte before it that is no white space (0: none)."""
    if not start:
        return 0, 0
    store, name = _store(path)
    run, counting = 0, True
    with store.open_input_file(name) as source:
        at = start
        while at:
            size = min(at, 4096)
            at -= size
            source.seek(at)
            for byte in reversed(source.read(size)):
                counting = counting and byte == _BACKSLASH
                run += counting
                if not counting and byte not in _SPACE:
                    return run, byte if not run else _BACKSLASH
    return run, _BACKSLASH if run else 0


class _Marks:
    """Quotes and brackets of consecutive blocks."""

    def __init__(self, run: int, last: int):
        self.run, self.last = run, last

    def of(self, block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places and bytes of quotes that are not escaped and of all brackets, and the last byte before each ``{`` that is no space."""
        data = np.frombuffer(block, np.uint8)
        place = np.flatnonzero(_MARKS[data])
        mark = data[place]
        kept = np.ones(len(place), bool)
        quotes = np.flatnonzero(mark == _QUOTE)
        # only quotes after a backslash need a look at how many there are
        for i in quotes[data[place[quotes] - 1] == _BACKSLASH if len(quotes) else []].tolist() + ([0] if len(place) and place[0] == 0 else []):
            if mark[i] == _QUOTE:
                at = stop = int(place[i])
                while at and block[at - 1] == _BACKSLASH:
                    at -= 1
                kept[i] = (stop - at + (self.run if at == 0 else 0)) % 2 == 0
        before = np.zeros(len(place), np.uint8)
        for i in np.flatnonzero(mark == _OPEN).tolist():
            at = int(place[i])
            while at and block[at - 1] in _SPACE:
                at -= 1
            before[i] = block[at - 1] if at else self.last
        rest = block.rstrip(b"\\")
        self.run = len(block) - len(rest) + (self.run if not rest else 0)
        solid = block.rstrip(_SPACE)
        self.last = solid[-1] if solid else self.last
        return place[kept], mark[kept], before[kept]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path, start, end in zip(*(batch.column(c).to_pylist() for c in range(3))):
            quotes, outside, inside, seen = 0, 0, 0, start
            if end != _WHOLE:
                marks = _Marks(*_before(path, start))
                for block in _blocks(path, start, end):
                    _, mark, _ = marks.of(block)
                    odd = (quotes + np.cumsum(mark == _QUOTE)) % 2 == 1
                    step = _STEP[mark]
                    outside, inside = outside + int(step[~odd].sum()), inside + int(step[odd].sum())
                    quotes += int((mark == _QUOTE).sum())
                    seen += len(block)
                    if seen >= end:
                        break
            rows.append((path, start, end, quotes % 2, outside, inside))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, _COUNT_TYPES)], _COUNT_NAMES)


_COUNT_NAMES = ["path", "start", "end", "quotes", "outside", "inside"]
_COUNT_TYPES = [pa.string(), *[pa.int64()] * 5]


def _features(path: str, start: int, end: int, odd: int, depth: int) -> Iterator[bytes]:
    """Texts of the objects that open in the range as elements of an array in the collection."""
    marks = _Marks(*(_before(path, start) if end != _WHOLE else (0, 0)))
    pending: list[bytes] | None = None
    at = start
    for block in _blocks(path, start, end):
        place, mark, before = marks.of(block)
        string = (odd + np.cumsum(mark == _QUOTE)) % 2 == 1
        step = np.where(string, 0, _STEP[mark])
        level = depth + np.cumsum(step)
        opens = place[(step > 0) & (mark == _OPEN) & (level == 3) & (before != _COLON)]
        closes = place[(step < 0) & (mark == _CLOSE) & (level == 2)]
        if pending is not None:
            if not len(closes):
                pending.append(block)
            else:
                yield b"".join([*pending, block[:closes[0] + 1]])
                pending = None
        opens = opens[opens + at < end]
        for x, n in zip(opens.tolist(), np.searchsorted(closes, opens).tolist()):
            if n < len(closes):
                yield block[x:closes[n] + 1]
            else:
                pending = [block[x:]]
        odd, depth, at = int(odd + (mark == _QUOTE).sum()) % 2, int(level[-1]) if len(level) else depth, at + len(block)
        if at >= end and pending is None:
            return
    if pending is not None:
        raise ValueError(f"{path} ends inside a feature")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, held = [], 0
    for batch in batches:
        for found in zip(*(batch.column(c).to_pylist() for c in range(5))):
            for text in _features(*found):
                texts.append(text.decode(errors="replace"))
                held += len(text)
                if held > _BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["feature"])
                    texts, held = [], 0
    if texts:
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["feature"])


def collection_features(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per feature of the collections below ``path``: ``feature``, its JSON text."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    packed = F.col("path").rlike(_COMPRESSED)
    start = F.when(packed, F.array(F.lit(0).cast("bigint"))).otherwise(F.expr(f"sequence(0L, length - 1, {range_bytes}L)"))
    ranges = files.withColumn("start", F.explode(start)).select(
        "path", "start", F.when(packed, F.lit(_WHOLE)).otherwise(F.least(F.col("start") + range_bytes, "length")).alias("end"))
    tasks = max(1, min(files.select(F.sum(F.when(packed, 1).otherwise(F.ceil(F.col("length") / range_bytes)))).first()[0] or 1, 20_000))

    def spread(rows: DataFrame) -> DataFrame:
        return rows.repartition(tasks, "path", "start")
    counted = spread(ranges).mapInArrow(_count, "path string, start bigint, end bigint, quotes bigint, outside bigint, inside bigint")
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)

    def so_far(value: Column) -> Column:
        return F.coalesce(F.sum(value).over(earlier), F.lit(0))
    known = counted.withColumn("odd", so_far(F.col("quotes")) % 2).withColumn(
        "depth", so_far(F.when(F.col("odd") == 1, F.col("inside")).otherwise(F.col("outside"))))
    return spread(known.select("path", "start", "end", "odd", "depth")).mapInArrow(_read, "feature string")
