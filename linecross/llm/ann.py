"""Operator 11: nearest neighbours by balanced posting lists.

A bounded sample of different vectors is split again and again into parts of even size (k-means whose cost grows with the size of a
part); the members nearest to the last parts' means are the centroids. Every vector is indexed: a graph over the centroids leads to
those near it, it joins the list of the nearest one, and a vector on a boundary also joins up to ``REPLICAS`` lists whose centroids
are within ``1 + CLOSURE`` times that distance and not nearer to a list already taken than to the vector. A query goes through the
same graph and searches each list whose centroid is within ``1 + RATIO`` times the distance of its nearest centroid, so queries in
the middle of a list search few and queries on boundaries many; no number caps them. Distances in the lists are exact.

Copies are one entry with the ``k + 1`` least ids, which no query can tell from all of them; a first round per bucket of ids keeps a
vector with very many copies from one task. Lists and the queries of a list are dealt out in tiles of a fixed size, so a full list is
many tasks' work, and a task joins what it finds for a query in all its tiles before anything is shuffled. The driver holds the sample (``SAMPLE`` rows and ``SAMPLE_BYTES`` at most) and the centroids and graph, which are
broadcast and no more than an eighth of the sample in rows.

Cases: vectors that are null, empty, zero, or hold null, NaN or infinite components take no part, nor do those that have not the
commonest length (of equally common ones the greater). Rows equal in id and vector count once, and such a row is never its own
neighbour; an id with several vectors is several rows. Null ids come last among equal distances and ask nothing. Empty tables give
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from linecross.llm.common import stage
from linecross.staging import stage_observed

#: The index learns from at most so many vectors and bytes.
SAMPLE, SAMPLE_BYTES = 1 << 16, 1 << 26
#: Vectors per list, as far as the sample allows so many lists.
LIST_SIZE = 64
#: Lists per vector, and how much farther than the nearest centroid another list's may be.
REPLICAS, CLOSURE = 4, 0.1
#: A query searches lists whose centroids are at most so much farther than its nearest one.
RATIO = 0.22
#: Links of a centroid in the graph to its nearest ones, before links back are added.
LINKS = 16
#: Nearest centroids that a search goes on from, however far they are.
BEAM = 8
#: Vectors and queries of a tile.
TILE_VECTORS, TILE_QUERIES = 4096, 1024
#: A task hands on what it has found when it has met more queries than this.
BEST_QUERIES = 1 << 15
_ID_BUCKETS = 64


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a.astype(float, copy=False), b.astype(float, copy=False)  # single precision would lose near vectors that are far from 0
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T), 0)


def balanced_parts(sample: np.ndarray, most: int, ways: int = 8, rounds: int = 6, seed: int = 11) -> list[np.ndarray]:
    """Row numbers of parts with at most ``most`` rows each, split ``ways`` at a time."""
    rng, parts, open_parts = np.random.default_rng(seed), [], [np.arange(len(sample))]
    while open_parts:
        rows = open_parts.pop()
        if len(rows) <= most:
            parts.append(rows)
            continue
        n = min(ways, -(-len(rows) // most))
        points = sample[rows]
        means = points[rng.choice(len(rows), n, replace=False)]
        spread, sizes = float(points.var(0).sum()), np.full(n, len(rows) / n)
        for _ in range(rounds):
            part = (_squares(points, means) + spread * sizes / len(rows)).argmin(1)
            sizes = np.bincount(part, minlength=n).astype(float)
            for k in np.flatnonzero(sizes):
                means[k] = points[part == k].mean(0)
        split = [rows[part == k] for k in range(n) if sizes[k]]
        if max(map(len, split)) > 0.9 * len(rows):
            # One place holds nearly all: along any direction, an even cut.
            split = np.array_split(rows[np.argsort(points @ rng.standard_normal(points.shape[1]), kind="stable")], n)
        open_parts += split
    return parts


class CentroidGraph:
    """Centroids with links to near ones; searches run for many vectors at once."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(np.float32)
        n = len(centroids)
        links = [np.empty((0, 2), np.int64)]
        for first in range(0, n, 1024):
            block = _squares(self.centroids[first:first + 1024], self.centroids)
            block[np.arange(len(block)), first + np.arange(len(block))] = np.inf
            near = np.argpartition(block, min(LINKS, n - 1) - 1, 1)[:, :min(LINKS, n - 1)] if n > 1 else np.empty((1, 0), np.int64)
            links.append(np.stack([np.repeat(first + np.arange(len(block)), near.shape[1]), near.ravel()], 1))
        links = np.concatenate(links)
        links = np.unique(np.concatenate([links, links[:, ::-1]]), axis=0)
        self.starts = np.searchsorted(links[:, 0], np.arange(n + 1))
        self.heads = links[:, 1].astype(np.int32)
        # Entries lie far from each other, so that every remote group of centroids has one.
        entries, reach = [0], _squares(self.centroids[:1], self.centroids)[0]
        while len(entries) < min(n, int(n ** 0.5) + 1):
            entries.append(int(reach.argmax()))
            reach = np.minimum(reach, _squares(self.centroids[entries[-1:]], self.centroids)[0])
        self.entries = np.unique(entries)

    def search(self, vectors: np.ndarray, ratio: float) -> Iterator[tuple[int, np.ndarray]]:
        """For blocks of vectors: the first row's number, and distances to centroids, infinite for those not reached."""
        n = len(self.centroids)
        size = max(1, (1 << 22) // n)
        for first in range(0, len(vectors), size):
            block = vectors[first:first + size].astype(np.float32)
            found = np.full((len(block), n), np.inf, np.float32)
            found[:, self.entries] = np.sqrt(_squares(block, self.centroids[self.entries]))
            todo = np.isfinite(found)
            while True:
                bound = np.maximum(found.min(1) * (1 + ratio), np.partition(found, min(BEAM, n) - 1, 1)[:, min(BEAM, n) - 1])
                row, node = np.nonzero(todo & (found <= bound[:, None]))
                if not len(row):
                    break
                todo[row, node] = False
                counts = self.starts[node + 1] - self.starts[node]
                at = np.arange(counts.sum()) + np.repeat(self.starts[node] - (np.cumsum(counts) - counts), counts)
                fresh = np.zeros(found.shape, bool)
                fresh[np.repeat(row, counts), self.heads[at]] = True
                row, node = np.nonzero(fresh & np.isinf(found))
                for part in range(0, len(row), 1 << 16):
                    r, c = row[part:part + (1 << 16)], node[part:part + (1 << 16)]
                    apart = block[r] - self.centroids[c]
                    found[r, c] = np.sqrt(np.einsum("ij,ij->i", apart, apart))
                todo[row, node] = True
            yield first, found

    def lists_of(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and list of every place a vector takes."""
        rows, lists = [], []
        for first, found in self.search(vectors, CLOSURE):
            width = min(4 * REPLICAS, found.shape[1])
            near = np.argpartition(found, width - 1, 1)[:, :width]
            away = np.take_along_axis(found, near, 1)
            order = np.lexsort((near, away), axis=1)
            near, away = np.take_along_axis(near, order, 1), np.take_along_axis(away, order, 1)
            taken = np.zeros(near.shape, bool)
            taken[:, 0] = True
            for k in range(1, width):
                able = np.flatnonzero((away[:, k] <= away[:, 0] * (1 + CLOSURE)) & (taken.sum(1) < REPLICAS))
                if not len(able):
                    break
                place = self.centroids[near[able, k]]
                free = np.ones(len(able), bool)
                for j in range(k):
                    apart = np.sqrt(((place - self.centroids[near[able, j]]) ** 2).sum(1))
                    free &= ~taken[able, j] | (apart >= away[able, k])
                taken[able, k] = free
            row, col = np.nonzero(taken)
            rows.append(first + row)
            lists.append(near[row, col])
        return np.concatenate(rows), np.concatenate(lists)

    def lists_for(self, queries: np.ndarray, ratio: float = RATIO) -> tuple[np.ndarray, np.ndarray]:
        """Row and list of every search."""
        rows, lists = [], []
        for first, found in self.search(queries, ratio):
            row, node = np.nonzero(found <= found.min(1, keepdims=True) * (1 + ratio))
            rows.append(first + row)
            lists.append(node)
        return np.concatenate(rows), np.concatenate(lists)


def fit_centroids(sample: np.ndarray, lists: int) -> CentroidGraph:
    parts = balanced_parts(sample, max(1, -(-len(sample) // max(lists, 1))))
    middles = [rows[_squares(sample[rows].mean(0, keepdims=True), sample[rows])[0].argmin()] for rows in parts]
    return CentroidGraph(sample[np.sort(middles)])


def usable_vectors(table: DataFrame) -> DataFrame:
    """``vec_id``, ``vector`` and a 128-bit hash of it (``k1``, ``k2``) of the rows that take part."""
    whole = table.selectExpr("vec_id", "embedding AS vector").where(
        "size(vector) > 0 AND NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity')) AND exists(vector, x -> x <> 0)")
    sizes = whole.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return whole.where(F.size("vector") == F.lit(sizes[0].n if sizes else 0)).selectExpr(
        "vec_id", "vector", "xxhash64(vector) AS k1", "xxhash64(1, vector) AS k2")


def different_vectors(rows: DataFrame, k: int) -> DataFrame:
    """One row per vector, with the ``k + 1`` least ids that have it, nulls last. Vectors themselves are shuffled once."""
    least = Window.partitionBy("k1", "k2", "bucket").orderBy(F.asc_nulls_last("vec_id"))
    in_buckets = rows.select("k1", "k2", "vec_id").distinct().withColumn("bucket", F.expr(f"pmod(hash(vec_id), {_ID_BUCKETS})")).withColumn(
        "nth", F.row_number().over(least)).where(F.col("nth") <= k + 1)
    ids = f"slice(array_sort(collect_list(struct(vec_id IS NULL AS missing, vec_id))), 1, {k + 1}).vec_id"
    return rows.groupBy("k1", "k2").agg(F.first("vector").alias("vector")).join(
        in_buckets.groupBy("k1", "k2").agg(F.expr(ids).alias("ids")), ["k1", "k2"])


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _placed(rows: DataFrame, graph, search: bool) -> DataFrame:
    """Every row once for each list that it belongs to, or that it searches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"))
            row, number = graph.value.lists_for(vectors) if search else graph.value.lists_of(vectors)
            for first in range(0, len(row), 1 << 14):
                part = batch.take(pa.array(row[first:first + (1 << 14)]))
                yield part.append_column("list", pa.array(number[first:first + (1 << 14)], pa.int32()))
    return rows.mapInArrow(run, StructType([*rows.schema, StructField("list", IntegerType())]))


def nearest_in(vectors: np.ndarray, queries: np.ndarray, firsts: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: its number, the places of its ``n`` nearest vectors by exact distance and ``firsts``, and the distances."""
    vectors, queries = vectors.astype(float), queries.astype(float)
    squares = (vectors ** 2).sum(1)
    for first in range(0, len(queries), 256):
        block = queries[first:first + 256]
        rough = (block ** 2).sum(1)[:, None] + squares - 2 * (block @ vectors.T)
        # Rounding of the product is far below this; what may be among the nearest is measured exactly.
        slack = 1e-9 * ((block ** 2).sum(1) + squares.max())
        bound = np.partition(rough, min(n, len(vectors)) - 1, 1)[:, min(n, len(vectors)) - 1] + slack
        for k in range(len(block)):
            near = np.flatnonzero(rough[k] <= bound[k])
            score = np.sqrt(((vectors[near] - block[k]) ** 2).sum(1))
            best = np.lexsort((firsts[near], score))[:n]
            yield first + k, near[best], score[best]


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches cut where one of the columns changes."""
    for batch in batches:
        if batch.num_rows:
            values = [batch.column(c).to_numpy() for c in columns]
            changes = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1
            for first, end in zip([0, *changes], [*changes, batch.num_rows]):
                yield batch.slice(first, end - first)


class Best:
    """The nearest entries that one task has found for each query that it has met."""

    def __init__(self, n: int):
        self.n, self.cell = n, None
        #: By query: score, first id, key and ids of its best entries, in order.
        self.of: dict[tuple[int, int], list[tuple]] = {}

    def ask(self, queries: pa.RecordBatch, cell: dict) -> None:
        """Queries of a tile; those of the same tile that a batch before held stay."""
        keys = list(zip(queries.column("k1").to_pylist(), queries.column("k2").to_pylist()))
        if cell == self.cell:
            self.keys, self.queries = self.keys + keys, np.concatenate([self.queries, _matrix(queries.column("vector"))])
        else:
            self.cell, self.keys, self.queries = cell, keys, _matrix(queries.column("vector"))
        for key in keys:
            self.of.setdefault(key, [])

    def meet(self, entries: pa.RecordBatch) -> None:
        """Entries of the tile whose queries came last."""
        ids = entries.column("ids").to_pylist()
        keys = list(zip(entries.column("k1").to_pylist(), entries.column("k2").to_pylist()))
        firsts = np.array([np.inf if i[0] is None else i[0] for i in ids])
        for q, near, score in nearest_in(_matrix(entries.column("vector")), self.queries, firsts, self.n):
            known = self.of.setdefault(self.keys[q], [])
            worst = known[-1][:2] if len(known) == self.n else (np.inf, np.inf)
            fresh = [(s, firsts[v], keys[v], ids[v]) for v, s in zip(near.tolist(), score.tolist()) if (s, firsts[v]) <= worst]
            if fresh:
                merged = {entry[2]: entry for entry in known + fresh}.values()
                self.of[self.keys[q]] = sorted(merged, key=lambda e: e[:3])[:self.n]

    def rows(self) -> pa.RecordBatch:
        """What was found, which is then forgotten."""
        rows = [(*query, *key, ids, score) for query, entries in self.of.items() for score, _, key, ids in entries]
        self.of = {}
        kinds = [*[pa.int64()] * 4, pa.list_(pa.int64()), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows) if rows else [()] * 6, kinds)],
                                          ["q1", "q2", "k1", "k2", "ids", "score"])


def nearest_neighbours(table: DataFrame, k: int = 10, asks: str = "vec_id % 100 = 0") -> DataFrame:
    """The ``k`` nearest found of every row that ``asks``: ``query_id, rank, vec_id, score``."""
    spark = table.sparkSession
    rows = usable_vectors(table)
    entries, seen = stage_observed(different_vectors(rows, k), "vectors", n="count(*)", width="max(size(vector))")
    n, room = seen["n"], SAMPLE_BYTES // (4 * (seen["width"] or 1))
    share = min(1.0, min(SAMPLE, room) / max(n, 1))
    sample = entries.where(F.lit(share >= 1.0) | (F.expr(f"pmod(k2, {1 << 30})") < int(share * (1 << 30)))).orderBy("k1", "k2").select(
        "vector").toArrow()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not sample.num_rows:
        return spark.createDataFrame([], schema)
    points = _matrix(sample.column("vector")).astype(np.float32)
    graph = spark.sparkContext.broadcast(fit_centroids(points, max(1, min(n // LIST_SIZE, len(points) // 8))))

    asking = rows.where(asks).select("vec_id", "k1", "k2", "vector")
    index = stage(_placed(entries, graph, search=False), "lists")
    searches = stage(_placed(asking.groupBy("k1", "k2").agg(F.first("vector").alias("vector")), graph, search=True), "searches")
    # One row per list, and there are no more lists than an eighth of the sample: small enough for every task.
    tiles = index.groupBy("list").agg(F.expr(f"ceil(count(*) / {TILE_VECTORS})").alias("v_tiles")).join(
        searches.groupBy("list").agg(F.expr(f"ceil(count(*) / {TILE_QUERIES})").alias("q_tiles")), "list")
    tiles = F.broadcast(tiles)
    cell = ["list", "v_tile", "q_tile"]
    left = searches.join(tiles, "list").selectExpr("list", "explode(sequence(0, v_tiles - 1)) AS v_tile", "pmod(k2, q_tiles) AS q_tile",
                                                   "0 AS kind", "k1", "k2", "CAST(NULL AS array<bigint>) AS ids", "vector")
    right = index.join(tiles, "list").selectExpr("list", "pmod(k2, v_tiles) AS v_tile", "explode(sequence(0, q_tiles - 1)) AS q_tile",
                                                 "1 AS kind", "k1", "k2", "ids", "vector")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k + 1)
        for part in _runs(batches, [*cell, "kind"]):
            if part.column("kind")[0].as_py():
                best.meet(part)
            else:
                best.ask(part, part.slice(0, 1).select(cell).to_pylist()[0])
            if len(best.of) > BEST_QUERIES:
                yield best.rows()
        yield best.rows()

    found = left.unionByName(right).repartition(*cell).sortWithinPartitions(*cell, "kind").mapInArrow(
        compare, "q1 bigint, q2 bigint, k1 bigint, k2 bigint, ids array<bigint>, score double")
    # A vector of several lists is found several times with one score, so dense ranks count it once.
    nearest = Window.partitionBy("q1", "q2").orderBy("score", F.expr("ids[0]").asc_nulls_last(), "k1", "k2")
    best = found.withColumn("nth", F.dense_rank().over(nearest)).where(F.col("nth") <= k + 1).dropDuplicates(["q1", "q2", "k1", "k2"])
    answers = asking.select(F.col("vec_id").alias("query_id"), F.col("k1").alias("q1"), F.col("k2").alias("q2")).distinct().join(
        best, ["q1", "q2"]).select("*", F.explode("ids").alias("vec_id")).where(
            "NOT (vec_id <=> query_id AND k1 = q1 AND k2 = q2)")
    order = Window.partitionBy("query_id", "q1", "q2").orderBy("score", F.asc_nulls_last("vec_id"))
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
