"""Operator 4: benchmark passages in documents, by CGK embedding and repeated bit-sampling.

Words are lower-cased (A-Z) and freed of ASCII punctuation. A document holds an item if some run of its words is within word edit
distance ``floor(max_share * item words)`` of the item's words.

The CGK embedding walks along a word sequence: step *j* writes down the current word, and a random function of *j* and the word says
whether to move on. Sequences within a small edit distance fall back into step soon, so their walks differ at few places. Bit
sampling then draws a few places of the walk; equal draws meet in a hash table, and several walks with several draws each reach the
target recall (tests measure it). Windows are as long as the item, up to the next length class below; every start in a document is
considered. A window walks only if it passes two tests which no window within the distance fails: it has enough words that occur in
any item, and one of the rarest words of some item where that item would have it. Every candidate is verified exactly, by an edit distance that lets
the document's part begin and end anywhere near the window.

Items are handled in blocks of bounded size, each broadcast in turn, so the benchmark may be of any size.

Cases: null and empty texts and items match nothing; an item of so few words that the distance is 0 must occur exactly; copies of
an item are matched each; repeated rows are searched each; an empty table gives no rows; texts of any length are searched whole.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from linecross.llm.common import fold_ascii, map_batches, ranges

#: Items are broadcast in blocks of about so many bytes of text.
BLOCK_BYTES = 32 << 20
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
#: Random values for the walks, fixed by their seeds.
_STEPS = 4096
_HAS, _SPREAD = 1 << 24, 7_368_787
MATCHES = "doc_id bigint, item_id bigint, first_word int, n_words int, distance int"


def normal_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(fold_ascii, _PUNCTUATION).split() if text else []


def infix_distance(item: np.ndarray, part: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of the item to any run of ``part``, with the run's start and end (the first of the shortest)."""
    n = len(part)
    row, origin, places = np.zeros(n + 1, np.int64), np.arange(n + 1), np.arange(n + 1)
    for i, word in enumerate(item, 1):
        # One key per cell: distance first, then the later start, so that ties keep the shorter run.
        best = np.empty(n + 1, np.int64)
        source = np.empty(n + 1, np.int64)
        best[0], source[0] = i, 0
        diagonal, above = row[:-1] + (part != word), row[1:] + 1
        use = diagonal <= above
        best[1:], source[1:] = np.where(use, diagonal, above), np.where(use, origin[:-1], origin[1:])
        # Insertions run along the row: cell j takes the least of best[k] + (j - k).
        shifted = best - places
        low = np.minimum.accumulate(shifted)
        at = np.maximum.accumulate(np.where(shifted == low, places, 0))
        row, origin = low + places, source[at]
    end = int(row.argmin())
    return int(row[end]), int(origin[end]), end


class Items:
    """The search structure of a block of items: (id, text) pairs."""

    def __init__(self, items: list[tuple[int, str]], max_share: float, walks: int, draws: int, sampled: int, seed: int = 11):
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[int, np.ndarray, int]] = []
        for item_id, text in items:
            found = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in normal_words(text)]
            if found:
                self.items.append((item_id, np.array(found), int(max_share * len(found))))
        self.walks = walks
        random = np.random.default_rng(seed)
        self.moves = random.integers(0, 1 << 62, (walks, _STEPS), np.int64)
        self.mix = random.integers(1, 1 << 62, len(self.vocabulary) + 1, np.int64) | 1
        self.mix[0] = 1
        self.classes: list[dict] = []
        by_length: dict[int, list[int]] = defaultdict(list)
        for n, (_, words, _) in enumerate(self.items):
            by_length[self._class(len(words))].append(n)
        # Words by how many items have them: the order only decides how many windows walk, not what is found.
        spelled = ["", *self.vocabulary]
        often = Counter(w for _, words, _ in self.items for w in set(words.tolist()))
        for length, members in sorted(by_length.items()):
            postings = []
            for n in members:
                _, words, most = self.items[n]
                left = most + 1
                for word, times in sorted(Counter(words.tolist()).items(), key=lambda x: (often[x[0]], -len(spelled[x[0]]), x[0])):
                    if left <= 0:
                        break
                    postings += [(word, n, offset) for offset in np.flatnonzero(words == word).tolist()]
                    left -= times
            postings = np.array(sorted(postings))
            first = np.searchsorted(postings[:, 0], np.arange(len(self.vocabulary) + 2))
            drawn = [np.sort(random.choice(min(2 * length, _STEPS), min(sampled, 2 * length), replace=False)) for _ in range(walks * draws)]
            tables = []
            windows = [self.items[n][1][:length] for n in members]
            padded = np.concatenate(windows)
            starts = np.cumsum([0, *map(len, windows[:-1])])
            for walk in range(walks):
                mine = drawn[walk * draws:(walk + 1) * draws]
                lists = []
                for hashes in self._draw(padded, starts, length, walk, mine):
                    order = np.argsort(hashes, kind="stable")
                    lists.append((hashes[order], np.array(members)[order]))
                tables.append((mine, lists))
            self.classes.append({"length": length, "postings": postings[:, 1:], "first": first, "tables": tables})
        # Which words an item has, as a table of bits by hash: it may say yes too often, never no wrongly.
        self.has = np.zeros(_HAS, bool)
        for n, (_, words, _) in enumerate(self.items):
            self.has[(n * _SPREAD + words) % _HAS] = True
        self.sizes = np.array([len(words) for _, words, _ in self.items])
        self.most = np.array([most for _, _, most in self.items])

    @staticmethod
    def _class(length: int) -> int:
        """The greatest class length at or below a length: each is about a sixth above the one before."""
        found = 1
        while (after := max(found + 1, found * 7 // 6)) <= length:
            found = after
        return found

    def _draw(self, ids: np.ndarray, starts: np.ndarray, length: int, walk: int, draws: list[np.ndarray]) -> list[np.ndarray]:
        """Hashes, for each draw, of the words that a walk from each start writes down at the drawn steps; past the window it writes 0."""
        at, out = starts.astype(np.int64), [np.zeros(len(starts), np.int64) for _ in draws]
        last = np.minimum(starts + length, len(ids))
        ids = np.append(ids, 0)
        drawn = [set(places.tolist()) for places in draws]
        with np.errstate(over="ignore"):
            for step in range(max(int(places[-1]) for places in draws) + 1):
                word = self.mix[ids[at]]
                word[at >= last] = 1
                for k, places in enumerate(drawn):
                    if step in places:
                        out[k] = (out[k] ^ word) * np.int64(0x9E3779B97F4A7C1)
                        out[k] ^= out[k] >> 29
                at += ((word * self.moves[walk, step]) >> 40) & 1
                np.minimum(at, last, out=at)
        return out

    def _windows(self, ids: np.ndarray, begin: np.ndarray, ends: np.ndarray, known: np.ndarray, kind: dict) -> np.ndarray:
        """Starts that pass both tests of a class: where an item would start, give or take its distance, for a key word found here."""
        first = kind["first"]
        counts = first[ids + 1] - first[ids]
        at = np.flatnonzero(counts)
        counts = counts[at]
        which = np.repeat(first[ids[at]] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        item, offset = kind["postings"][which].T
        at = np.repeat(at, counts)
        low, high, start, most = begin[at], ends[at], at - offset, self.most[item]
        near = np.maximum(start - most, low), np.minimum(start + self.sizes[item] + most, high)
        good = known[np.maximum(near[1], near[0])] - known[near[0]] >= self.sizes[item] - most
        low, high = np.maximum(start - most, low)[good], np.minimum(start + most + 1, high)[good]
        return np.unique(ranges(low, np.maximum(high - low, 0)))

    def _enough(self, ids: np.ndarray, begin: np.ndarray, ends: np.ndarray, item: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Whether so many words near a start seem to be the item's that its distance is not ruled out."""
        low = np.maximum(start - 2 * self.most[item], begin[start])
        high = np.minimum(start + self.sizes[item] + 2 * self.most[item], ends[start])
        good = np.zeros(len(item), bool)
        for part in range(0, len(item), 20_000):
            cut = slice(part, part + 20_000)
            counts = high[cut] - low[cut]
            hit = self.has[(np.repeat(item[cut] * _SPREAD, counts) + ids[ranges(low[cut], counts)]) % _HAS]
            good[cut] = np.add.reduceat(hit, np.cumsum(counts) - counts, dtype=np.int64) >= (self.sizes - self.most)[item[cut]]
        return good

    def search(self, rows: list[int], texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(row, item, first word, words, distance) of each item in each text."""
        get, parts, sizes = self.vocabulary.get, [], []
        for text in texts:
            words = normal_words(text)
            sizes.append(len(words))
            parts.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
        if not sum(sizes):
            return []
        ids, sizes = np.concatenate(parts), np.array(sizes)
        document = np.repeat(np.arange(len(sizes)), sizes)
        begin = np.cumsum(sizes) - sizes
        first_of, ends = begin[document], (begin + sizes)[document]
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        for kind in self.classes:
            starts = self._windows(ids, first_of, ends, known, kind)
            if not len(starts):
                continue
            pairs = []
            for walk, (draws, lists) in enumerate(kind["tables"]):
                for drawn, (hashes, members) in zip(self._draw(ids, starts, kind["length"], walk, draws), lists):
                    left, right = np.searchsorted(hashes, drawn), np.searchsorted(hashes, drawn, "right")
                    hit = np.flatnonzero(right > left)
                    if len(hit):
                        counts = right[hit] - left[hit]
                        pairs.append(members[ranges(left[hit], counts)] * len(ids) + np.repeat(starts[hit], counts))
            if not pairs:
                continue
            item, start = np.divmod(np.unique(np.concatenate(pairs)), len(ids))
            good = self._enough(ids, first_of, ends, item, start)
            for n, start in zip(item[good].tolist(), start[good].tolist()):
                own = int(document[start])
                item_id, words, most = self.items[n]
                seen = found.get((own, n))
                if seen is not None and (seen[2] == 0 or start <= seen[0] + seen[1]):
                    continue
                low, high = max(int(begin[own]), start - 2 * most), min(int(ends[start]), start + len(words) + 2 * most)
                near = ids[low:high]
                if np.isin(near, words).sum() < len(words) - most:
                    continue
                distance, first, last = infix_distance(words, near)
                if distance <= most and (seen is None or distance < seen[2]):
                    found[own, n] = (low + first, last - first, distance)
        return [(rows[own], self.items[n][0], first - int(begin[own]), size, distance)
                for (own, n), (first, size, distance) in found.items()]


def item_blocks(benchmark: DataFrame, max_share: float = 0.25, walks: int = 4, draws: int = 8, sampled: int = 3):
    """Search structures of the benchmark, a block at a time."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text IS NOT NULL AND item_id IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield Items([(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()], max_share, walks, draws, sampled)


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str | Column = "doc_id", **options) -> DataFrame:
    """One row per document and item found in it: where it was found first at its least distance, in normalised words."""
    spark = docs.sparkSession
    texts = docs.select((F.col(key) if isinstance(key, str) else key).alias("key"), "text")
    results = []
    for block in item_blocks(benchmark, **options):
        shared = spark.sparkContext.broadcast(block)

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            rows = []
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                rows += shared.value.search(range(first, first + part.num_rows), part.column(1).to_pylist())
            keys = batch.column(0).to_pylist()
            columns = list(zip(*rows)) or [()] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array([keys[r] for r in columns[0]], pa.int64()), *(pa.array(c, t) for c, t in zip(
                    columns[1:], (pa.int64(), pa.int32(), pa.int32(), pa.int32())))], [p.split()[0] for p in MATCHES.split(", ")])

        results.append(map_batches(texts, run, MATCHES))
    return reduce(DataFrame.unionAll, results) if results else spark.createDataFrame([], MATCHES)


def drop_leaked(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    kept = docs
    for block in item_blocks(benchmark, **options):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            texts, hit = batch.column("text"), np.zeros(batch.num_rows, bool)
            for first in range(0, batch.num_rows, 256):
                part = texts.slice(first, 256).to_pylist()
                hit[[r[0] for r in shared.value.search(range(first, first + len(part)), part)]] = True
            return batch.filter(pa.array(~hit))

        kept = map_batches(kept, run, kept.schema)
    return kept
