"""Operator 10: which documents' sets of word n-grams are similar, by a Jaccard join that skips by set relations.

A document's set holds hashes of its distinct n-word shingles (A-Z in lower case). Equal sets are one node. Two nodes link when the
share of common shingles reaches the threshold; the result is the component of every document.

*Prefixes.* Shingles are ordered by how often they seem to occur, rare ones first. The counts are sums over all data in a fixed number
of hash buckets; any order gives the same links, a good one keeps frequent shingles out of the index. Similar sets share a
shingle among the first ``n - ceil(t * n) + 1`` of both, so only these are listed.

*Lists.* The list of a shingle is ordered by size class and position. The first entry of a class is its hub: it has the fewest rare
shingles before the common one, as the original of a group of edited copies does. Lists of seemingly frequent shingles are dealt out
over several partitions by salt. Every set takes the hub and the list neighbour that it meets most often as sets it probably
resembles; these pairs, two per set at most, are verified first.

*Answers from similar sets.* A set that turns out to resemble another needs no answers of its own inside the other's component, so
only list entries of different components are compared from there on. They are grouped into blocks of a component and size class,
which carry the smallest position and the span of sizes: two blocks are skipped whole if no pair of theirs can overlap enough from
there. Pairs that remain are verified on their whole sets.

Cases: null and wordless texts have an empty set and link with nothing; with fewer words than n the whole sequence is the one
shingle; a null id is kept, links like any other
and never names a component that has other ids; repeated rows share a node; an empty table gives an empty
result. 64-bit hashes stand for shingles and sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linecross.llm.common import byte_slices, discard, give_back, hashed_words, map_batches, mix64, stage
from linecross.operators.components import connected_components

#: Buckets of the estimate of shingle counts: a table of fixed size, whatever the corpus.
BUCKETS, CHUNK = 1 << 20, 1 << 14
_SHIFT = np.uint64(64 - 20)
#: Hashes of sets that a task remembers, to list copies once.
SEEN = 1 << 20


def shingle_sets(texts: list[str | None], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each text, and how many each text has."""
    words, counts = hashed_words(texts)
    if not len(words):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.cumsum(counts) - counts
    # Windows of n words, and for shorter texts one window of all words, salted by its length.
    last = np.arange(len(words)) + n <= (first + counts)[owner]
    short = (counts > 0) & (counts < n)
    with np.errstate(over="ignore"):
        value = np.zeros(len(words), np.uint64)
        for k in range(n):
            reach = slice(0, max(0, len(words) - k))
            value[reach] = value[reach] * np.uint64(0xD1342543DE82EF95) + words[k:]
        found, own = mix64(value[last]), owner[last]
        if short.any():
            for text in np.flatnonzero(short):
                value = np.uint64(counts[text])
                for w in words[first[text]:first[text] + counts[text]]:
                    value = value * np.uint64(0x2545F4914F6CDD1D) + w
                found, own = np.append(found, mix64(np.array([value]))), np.append(own, text)
    order = np.lexsort((found, own))
    found, own = found[order], own[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (own[1:] != own[:-1])
    return found[fresh], np.bincount(own[fresh], minlength=len(texts))


def _signatures(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each non-empty set; empty sets are left out."""
    full = sizes[sizes > 0]
    if not len(full):
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        total = np.add.reduceat(mix64(sets + np.uint64(0x632BE59BD9B4E019)), np.cumsum(full) - full)
        return mix64(total + full.astype(np.uint64)).view(np.int64)


def _scan(docs: DataFrame, n: int) -> tuple[DataFrame, np.ndarray]:
    """Staged (doc_id, row, n_shingles, sig), and the count of shingles in each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in byte_slices(batch, "text"):
                sets, sizes = shingle_sets(part.column("text").to_pylist(), n)
                counted += np.bincount((sets >> _SHIFT).astype(np.int64), minlength=BUCKETS)
                sig = np.zeros(len(sizes), np.int64)
                sig[sizes > 0] = _signatures(sets, sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row"), pa.array(sizes), pa.array(sig, mask=sizes == 0),
                     pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())], _SCAN)
        chunks = [c for c in range(BUCKETS // CHUNK) if counted[c * CHUNK:(c + 1) * CHUNK].any()]
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(len(chunks), pa.int64())] * 4,
             pa.array(chunks, pa.int32()), pa.array([counted[c * CHUNK:(c + 1) * CHUNK].astype("<i8").tobytes() for c in chunks], pa.binary())], _SCAN)
        give_back()

    staged = stage(docs.select("doc_id", "row", "text").mapInArrow(
        run, "doc_id bigint, row bigint, n_shingles bigint, sig bigint, chunk int, counts binary"), "sets")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                                         ["chunk", "counts"])

    parts = staged.where("chunk IS NOT NULL").select("chunk", "counts")
    summed = parts.repartition(F.col("chunk")).mapInArrow(add, "chunk int, counts binary")
    table = np.zeros(BUCKETS, np.int64)
    for row in summed.collect():  # BUCKETS numbers
        table[row.chunk * CHUNK:(row.chunk + 1) * CHUNK] += np.frombuffer(row.counts, "<i8")
    return staged.where("chunk IS NULL").select("doc_id", "row", "n_shingles", "sig"), table


_SCAN = ["doc_id", "row", "n_shingles", "sig", "chunk", "counts"]


def _postings(docs: DataFrame, table: np.ndarray, n: int, percent: int) -> DataFrame:
    """(token, salt, class, pos, n, sig) for the prefix of every set. A list expects ``2 ** 12`` entries per salt at most."""
    shared = docs.sparkSession.sparkContext.broadcast(table.astype(np.int64))  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, seen = shared.value, np.empty(0, np.int64)
        usual = int(np.median(counted))
        for batch in batches:
            for part in byte_slices(batch, "text"):
                sets, sizes = shingle_sets(part.column("text").to_pylist(), n)
                sig = _signatures(sets, sizes)
                sizes = sizes[sizes > 0]
                # Copies of a set that this task has listed already add nothing.
                fresh = np.zeros(len(sig), bool)
                fresh[np.unique(sig, return_index=True)[1]] = True
                fresh &= ~np.isin(sig, seen)
                seen = np.union1d(seen, sig) if len(seen) < SEEN else np.unique(sig)
                if not fresh.any():
                    continue
                sets = sets[np.repeat(fresh, sizes)]
                sig, sizes = sig[fresh], sizes[fresh]
                size_class = np.floor(np.log(sizes) / np.log(100 / percent)).astype(np.int32)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                often = counted[(sets >> _SHIFT).astype(np.int64)]
                order = np.lexsort((sets, often, owner))
                pos = np.arange(len(sets)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                prefix = sizes - -(-percent * sizes // 100) + 1
                kept = pos < prefix[owner]
                chosen, owner, pos = order[kept], owner[kept], pos[kept]
                salts = 1 + np.maximum(0, often[chosen] - 2 * usual) // 4096
                salt = (sig[owner].view(np.uint64) % salts.astype(np.uint64)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(sets[chosen].view(np.int64)), pa.array(salt), pa.array(size_class[owner]),
                                                  pa.array(pos.astype(np.int32)), pa.array(sizes[owner].astype(np.int32)), pa.array(sig[owner])], _POSTING)
        give_back()

    return docs.select("text").mapInArrow(run, "token bigint, salt int, class int, pos int, n int, sig bigint")


_POSTING = ["token", "salt", "class", "pos", "n", "sig"]


def _shared_lists(postings: DataFrame) -> DataFrame:
    """Entries of lists that may have company, each with the entry before it in the list and the hub of its size class.

    Copies of a set are one entry. Lists arrive whole and ordered, but only an entry and a hub are held beyond the batch, so a list
    may be of any length.
    """
    ordered = postings.repartition(F.col("token"), F.col("salt")).sortWithinPartitions("token", "salt", "class", "pos", "n", "sig")

    def emit(rows: list[np.ndarray], context: bool, last: bool) -> tuple[pa.RecordBatch, list[np.ndarray]]:
        """Rows hold a hub, a past entry if ``context``, new entries, and one still to come unless ``last``."""
        token, salt, size_class, pos, n, sig = rows
        size = len(token)
        same = np.zeros(size + 1, bool)
        same[1:size] = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1])
        opens = ~same[:-1]
        opens[1:] |= size_class[1:] != size_class[:-1]
        hub = np.maximum.accumulate(np.where(opens, np.arange(size), 0))
        same[1] &= context
        take = same[:-1] | same[1:] | (salt > 0)
        take[1:] &= ~(same[1:size] & (sig[1:] == sig[:-1]))
        take[:1 + context] = False
        take[-1] &= last
        at = np.flatnonzero(take)
        before, alone, own = np.maximum(at - 1, 0), ~same[at], sig[hub[at]] == sig[at]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(token[at]), pa.array(sig[at]), pa.array(n[at]), pa.array(pos[at]), pa.array(sig[before], mask=alone), pa.array(n[before], mask=alone),
             pa.array(sig[hub[at]], mask=own), pa.array(n[hub[at]], mask=own)], ["token", "sig", "n", "pos", "near", "near_n", "hub", "hub_n"])
        # The hub of the entry that stands last but one leads the next rows.
        return batch, [r[[hub[-2], -2, -1]] for r in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last entry of a batch waits until the one after it is known; the entry before it is kept for comparison, the hub for pairs.
        held, context = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy() for c in _POSTING]
            # The first entry of all stands in for the hub.
            rows = [np.concatenate([r[:1] if held is None else h, r]) for h, r in zip(held or rows, rows)]
            if len(rows[0]) > 2 + context:
                out, held = emit(rows, context, False)
                yield out
                context = True
            else:
                held = rows
        if held is not None:
            yield emit(held, context, True)[0]

    return ordered.mapInArrow(run, "token bigint, sig bigint, n int, pos int, near bigint, near_n int, hub bigint, hub_n int")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of nodes, those whose sets reach the threshold. ``sets``: staged (sig, set)."""
    left = pairs.join(sets.select(F.col("sig").alias("a"), F.col("set").alias("set_a")), "a")
    both = left.join(sets.select(F.col("sig").alias("b"), F.col("set").alias("set_b")), "b")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = np.zeros(batch.num_rows, bool)
        for k, (x, y) in enumerate(zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())):
            x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            common = len(np.intersect1d(x, y, assume_unique=True))
            good[k] = 100 * common >= percent * (len(x) + len(y) - common)
        return batch.select(["a", "b"]).filter(pa.array(good))

    return map_batches(both.select("a", "b", "set_a", "set_b"), run, "a bigint, b bigint")


def _sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(sig, set) of the wanted nodes, from the text of one document each, and from all rows without an id for nodes of such rows alone."""
    asked = nodes.join(wanted, "sig")
    named = docs.join(asked.where("doc_id IS NOT NULL").select("doc_id").distinct(), "doc_id", "left_semi")
    texts = named.unionByName(docs.where("doc_id IS NULL")).select("text")

    def run(batch: pa.RecordBatch) -> pa.Table:
        out = []
        for part in byte_slices(batch, "text"):
            sets, sizes = shingle_sets(part.column("text").to_pylist(), n)
            sig = _signatures(sets, sizes)
            sizes = sizes[sizes > 0]
            parts = np.split(sets, np.cumsum(sizes)[:-1]) if len(sizes) else []
            out.append(pa.RecordBatch.from_arrays([pa.array(sig), pa.array([p.astype("<u8").tobytes() for p in parts], pa.binary())], ["sig", "set"]))
        return pa.Table.from_batches(out, pa.schema([("sig", pa.int64()), ("set", pa.binary())]))

    return map_batches(texts, run, "sig bigint, set binary").join(asked.select("sig"), "sig", "left_semi").dropDuplicates(["sig"])


def _components(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Staged (doc_id, row, n_shingles, sig) of ``docs`` (doc_id, row, text), and (sig, doc_id, root): every node, the least id that
    has it, and its component."""
    rows, table = _scan(docs, n)
    lists = stage(_shared_lists(_postings(docs, table, n, percent)), "lists")
    nodes = rows.where("sig IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))

    def fits(a: str, b: str) -> str:
        return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"

    # One hub and one neighbour per set: those it meets in most lists.
    both = lists.select("sig", F.explode(F.array(
        F.expr(f"if({fits('n', 'hub_n')}, struct(true AS is_hub, hub AS other), null)"),
        F.expr(f"if({fits('n', 'near_n')}, struct(false AS is_hub, near AS other), null)"))).alias("m")).where("m.other IS NOT NULL")
    met = both.groupBy("sig", "m.is_hub", "m.other").agg(F.count(F.lit(1)).alias("lists"))
    best = met.groupBy("sig", "is_hub").agg(F.max_by("other", F.struct("lists", "other")).alias("other"))
    first = stage(best.selectExpr("greatest(sig, other) AS a", "least(sig, other) AS b").distinct(), "first-pairs")
    wanted = first.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    sets = stage(_sets_of(docs, nodes, wanted, n), "wanted-sets")
    links = stage(_verified(first, sets, percent), "links")
    discard(sets)
    roots = connected_components(links)

    # From here on only list entries of different components meet.
    labelled = lists.select("token", "sig", "n", "pos").join(roots.selectExpr("node AS sig", "root"), "sig", "left").withColumn(
        "comp", F.coalesce("root", "sig")).drop("root")
    mixed = labelled.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("token")
    entries = stage(labelled.join(mixed, "token", "left_semi").withColumn(
        "size", F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent))).cast("int")), "entries")
    blocks = entries.groupBy("token", "comp", "size").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("pos")).alias("room"))
    x, y = blocks.alias("x"), blocks.alias("y")
    need = f"{percent} * (x.low + y.low) <= {100 + percent} * least(x.room, y.room)"
    near = x.join(y, F.expr(f"x.token = y.token AND x.comp < y.comp AND 100 * x.high >= {percent} * y.low AND "
                            f"100 * y.high >= {percent} * x.low AND {need}")).selectExpr(
        "x.token", "x.comp AS comp_x", "x.size AS size_x", "y.comp AS comp_y", "y.size AS size_y")
    one = entries.selectExpr("token", "comp AS comp_x", "size AS size_x", "sig AS a", "n AS n_a", "pos AS pos_a")
    two = entries.selectExpr("token", "comp AS comp_y", "size AS size_y", "sig AS b", "n AS n_b", "pos AS pos_b")
    pairs = near.join(one, ["token", "comp_x", "size_x"]).join(two, ["token", "comp_y", "size_y"]).where(
        f"{fits('n_a', 'n_b')} AND {percent} * (n_a + n_b) <= {100 + percent} * least(n_a - pos_a, n_b - pos_b)").selectExpr(
        "greatest(a, b) AS a", "least(a, b) AS b").distinct()
    rest = stage(pairs.join(first, ["a", "b"], "left_anti"), "rest-pairs")
    wanted = rest.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    sets = stage(_sets_of(docs, nodes, wanted, n), "wanted-sets")
    more = stage(_verified(rest, sets, percent), "links")
    discard(sets, entries, lists)
    roots = connected_components(links.unionAll(more))

    of_node = nodes.join(roots.selectExpr("node AS sig", "root"), "sig", "left")
    return rows, of_node.select("sig", "doc_id", F.coalesce("root", "sig").alias("root"))


def similar_documents(docs: DataFrame, n: int = 5, percent: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row; sets link at ``percent`` per cent of their union."""
    rows, nodes = _components(docs.selectExpr("doc_id", "0L AS row", "text"), n, percent)
    smallest = nodes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = nodes.join(smallest, "root").select("sig", "component_id")
    return rows.join(named, "sig", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one_per_group(docs: DataFrame, n: int = 5, percent: int = 75) -> DataFrame:
    """One row of ``docs`` per component: that with the least id (null last), of these with the least hash of all its columns.

    Rows equal in every column are one. Different texts that share an id but do not link both stay. Rows without words stay as they are.
    """
    marked = docs.withColumn("_row", F.xxhash64(*docs.columns))
    rows, nodes = _components(marked.select("doc_id", F.col("_row").alias("row"), "text"), n, percent)
    first = rows.join(nodes.select("sig", "root"), "sig").groupBy("root").agg(F.expr("min(struct(doc_id IS NULL AS missing, doc_id, row)) AS first"))
    kept = first.selectExpr("first.doc_id AS _id", "first.row AS _row")
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    named = marked.where(words).join(kept, (marked["_row"] == kept["_row"]) & marked["doc_id"].eqNullSafe(kept["_id"]), "left_semi")
    return named.dropDuplicates(["doc_id", "_row"]).select(*docs.columns).unionByName(docs.where(~words))
