"""Nearest vectors, fill-in-the-middle and conversation repair: brute force, exact round trips, SQL, and odd rows."""

import hashlib
import random
import zlib
from functools import lru_cache

import numpy as np
import pytest

from checks.compare import connect, differences
from linecross.llm import ann, conversations, fill_middle, queries

SF = "/root/testdata/sf0.001"
LONG = "word salad again\n" * 20_000


@pytest.mark.parametrize("name", ["op12_fill_middle", "op13_conversation_repair"])
def test_sql(spark, name):
    assert differences(spark, connect(SF), queries.QUERIES[name], queries.ORACLE[name], SF) is None


# --- 11 nearest vectors ----------------------------------------------------------------------------------


def brute_nearest(rows, k=10, every=100):
    """(query, vector's place) -> ranked (distance, id) of every other row."""
    different = list({(i, tuple(v)): None for i, v in rows})
    points, out = np.array([v for _, v in different], float), {}
    for n, (i, v) in enumerate(different):
        if i is not None and i % every == 0:
            away = np.sqrt(((points - points[n]) ** 2).sum(1))
            ranked = sorted((away[m], different[m][0] is None, different[m][0] or 0) for m in range(len(different)) if m != n)[:k]
            out[i, v] = [(i if not missing else None, d) for d, missing, i in ranked]
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v] if v is not None else None, "x", 1) for i, v in rows],
                                 "vec_id bigint, embedding array<float>, list string, k1 int")


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_and_exact_scores(spark):
    rows = [(r.vec_id, tuple(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got, want = found(queries.op11_nearest_vectors(spark, "/root/testdata/sf0.1")), brute_nearest(rows)
    by_id, hits = dict(rows), 0
    assert got.keys() == {i for i, _ in want}
    for (i, v), best in want.items():
        assert len(got[i]) == 10
        hits += len({n for n, _ in best} & {n for n, _ in got[i]})
        for n, score in got[i]:
            assert score == pytest.approx(np.sqrt(((np.array(by_id[n], float) - np.array(v, float)) ** 2).sum()), abs=1e-12)
        assert [(s, n) for n, s in got[i]] == sorted((s, n) for n, s in got[i])
    assert hits >= 0.9 * 10 * len(want)


@pytest.mark.parametrize("tile", [4096, 7])
def test_copies_ties_and_tiles(spark, monkeypatch, tile):
    # every list is searched, so the answers are exact: copies of one vector, a lattice full of ties, null ids, and rows twice
    monkeypatch.setattr(ann, "TILE_VECTORS", tile)
    monkeypatch.setattr(ann, "TILE_QUERIES", tile)
    monkeypatch.setattr(ann.CentroidGraph.lists_for, "__defaults__", (1e9,))
    rng = random.Random(4)
    rows = [(i, (1, 2, 3)) for i in range(0, 900)] + [(i, tuple(rng.randint(1, 3) for _ in range(3))) for i in range(900, 1300)]
    rows += [(None, (1, 2, 3)), (None, (2, 2, 2)), *rows[100:120], (500, (3, 3, 3)), (500, (2, 1, 2))]
    got = {}
    for r in ann.nearest_neighbours(vectors(spark, rows)).collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id is None, r.vec_id))
    want = {}
    for (i, _), best in brute_nearest(rows).items():
        want.setdefault(i, []).extend((d, n is None, n) for n, d in best)
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in want.items()}


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, (1, 0)), (1, (0, 1)), (2, None), (3, ()), (4, (0, 0)), (5, (nan, 1)), (6, (1, inf)), (7, (1, 2, 3)), (100, (2, 0)), (None, (3, 0))]
    frame = vectors(spark, rows).unionByName(spark.sql("SELECT 8L AS vec_id, array(1f, NULL) AS embedding, 'y' AS list, 2 AS k1"))
    assert found(ann.nearest_neighbours(frame)) == {0: [(100, 1.0), (1, pytest.approx(2 ** 0.5)), (None, 2.0)],
                                                    100: [(0, 1.0), (None, 1.0), (1, pytest.approx(5 ** 0.5))]}
    for none in (frame.where("false"), frame.where("vec_id IN (2, 3, 4)"), frame.where("vec_id = 1")):
        assert ann.nearest_neighbours(none).count() == 0


def test_graph_search_reaches_remote_groups():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.standard_normal((300, 5)) + 1000 * k for k in range(5)])
    graph = ann.fit_centroids(points, 200)
    sizes = [len(p) for p in ann.balanced_parts(points, 8)]
    assert sum(sizes) == 1500 and max(sizes) <= 8
    away = ann._squares(points, graph.centroids.astype(float)) ** 0.5
    for first, reached in graph.search(points, 0.0):
        rows = slice(first, first + len(reached))
        assert (np.abs(reached.min(1) - away[rows].min(1)) < 1.0).mean() >= 0.99
    row, number = graph.lists_of(points)
    assert set(row) == set(range(1500)) and np.bincount(row).max() <= ann.REPLICAS
    same = np.ones((1000, 4))
    assert sum(map(len, ann.balanced_parts(same, 8))) == 1000


# --- 12 fill in the middle -------------------------------------------------------------------------------


def plain_example(doc_id, text):
    text = text or ""
    units = [u + "\n" for u in text.split("\n")[:-1]] + ([text.split("\n")[-1]] if text.split("\n")[-1] else [])
    name = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(name[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    parts = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    spm = h[3] % 100 < 50
    output = f"<S>{parts[2]}<P>{parts[0]}<M>{parts[1]}" if spm else f"<P>{parts[0]}<S>{parts[2]}<M>{parts[1]}"
    return len(units), "spm" if spm else "psm", len(parts[0]), len(parts[1]), output


ODD = ["", None, "\n", "\n\n", "a", "a\n", "\na", "a\r\nb\r\n", "<P", "S>", "x<S>y\nz", "<M>", "x\n<\nP>", "ä\nÖß\U0001f600\n \n", LONG, "x" * 70_000, "a\x00b\nc"]


def test_examples_and_round_trip(spark, monkeypatch):
    for size in (1 << 22, 10):
        monkeypatch.setattr(fill_middle, "SLICE_BYTES", size)
        rows = [(i, t) for i, t in enumerate(ODD * 3)] + [(None, "a\nb\nc"), (3, "a\nb"), (3, "a\nb")]
        frame = spark.createDataFrame([(i, t, "f", 5) for i, t in rows], "doc_id bigint, text string, form string, h1 int").repartition(3)
        got = fill_middle.restored_texts(fill_middle.fill_in_middle(frame)).collect()
        assert len(got) == len(rows)
        want = sorted(((i if i is not None else -1, *plain_example(i, t), t or "") for i, t in rows), key=repr)
        assert sorted(((r.doc_id if r.doc_id is not None else -1, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got),
                      key=repr) == want
    assert fill_middle.fill_in_middle(frame.where("false")).count() == 0
    assert {r.form for r in fill_middle.fill_in_middle(frame, rate=0).collect()} == {"plain"}


# --- 13 conversations ------------------------------------------------------------------------------------


def least_edits(codes):
    """Every way at once: least (cost, letters) of each (row, state)."""
    step = {0: "u", 1: "u", 2: "a", 3: "u"}
    state_of = {"s": 1, "u": 2, "a": 3}

    @lru_cache(maxsize=None)
    def rest(at, state, inserts):
        ways = []
        if at == len(codes) and state in (0, 3):
            ways.append((0, ""))
        if inserts:
            ways.append(plus(3, "I", rest(at, state_of[step[state]], inserts - 1)))
        if at < len(codes):
            ways.append(plus(4, "D", rest(at + 1, state, 2)))
            code = codes[at]
            if code != ".":
                more = 3 if code.isupper() or code == "_" else 0
                if code.lower() == step[state] or code.lower() == "s" and state == 0:
                    ways.append(plus(more, "K", rest(at + 1, state_of[code.lower()], 2)))
                ways.append(plus(3 + more, "R", rest(at + 1, state_of[step[state]], 2)))
        return min((w for w in ways if w), default=None)

    def plus(cost, letter, way):
        return way and (way[0] + cost, letter + way[1])
    return rest(0, 0, 2)


def test_auction_against_every_way():
    rng = random.Random(8)
    for n in range(400):
        codes = "".join(rng.choice("sua-SUA_..uaua") for _ in range(rng.randint(0, 14)))
        for block in (1, 3, 32):
            assert conversations.cheapest_edits(codes, block) == least_edits(codes), (codes, block)
    long = "".join(rng.choice("uauauaU.s") for _ in range(600))
    assert conversations.cheapest_edits(long) == conversations.cheapest_edits(long, 600) == conversations.cheapest_edits(long, 7)


def test_prices_never_exceed_the_distance():
    codes = "suAau.ua-_"
    arcs = conversations._lattice(codes, (0, None, None, 0), True)
    price = conversations.auction(arcs, [0])
    assert all(price[n] <= cost + price[head] for n, out in enumerate(arcs) for _, cost, head in out)


def brute_repair(rows):
    """The contract, conversation by conversation, from rows (conv_id, turn, role, text)."""
    space, out = " \t\n\x0b\x0c\r", {}
    shown = lambda v: " " if v is None else str(v)
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            key = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
            text = "" if key == 1 else "".join(c for c in text if c not in ".!?") if key == 2 else text
            kept += [(turn, "user" if key == 4 else role, text)] * (0 if key == 0 else 2 if key == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, codes, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in kept:
            body, initial = text.rstrip(space), role[:1] if role[:1] in ("s", "u", "a") else "-"
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            codes += "." if fault in ("blank", "duplicate") else {"-": "_"}.get(initial, initial.upper()) if fault else initial
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit = least_edits(codes)
        left, at, last = [], 0, ""
        for letter in audit:
            due = "assistant" if last == "u" else "user"
            if letter == "I":
                left.append((due, ""))
            else:
                if letter != "D":
                    left.append((due if letter == "R" else kept[at][1], kept[at][2]))
                at += 1
            last = left[-1][0][:1] if left else ""
        turns = [r[0] for r in kept if r[0] is not None]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *faults.values(), illegal, cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest())
    return out


def test_repair_against_brute_force(spark):
    rng = random.Random(3)
    texts = ["One.", "Two!", "Two!", "three", "", None, " \t\n", "Fünf? ", "a.b", "x\x0b"]
    roles = ["user", "assistant", "system", "tool", None, "", "assistant", "user", "umpire"]
    rows = [(conv, rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for conv in [*range(40), None] for _ in range(rng.randint(1, 9))]
    rows += [(77, t, ("user", "assistant")[t % 2], f"{t}." if t % 7 else "Again.") for t in range(150)] + [(78, 0, "user", LONG), (78, 1, "assistant", LONG + ".")]
    rows += [(79, 3, "user", "Same.")] * 50 + [(80, 1 << 40, "user", "a."), (80, -5, "assistant", "b.")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, fault string, copies int")
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair_digests(frame.repartition(5)).collect()}
    assert got == brute_repair(rows)
    assert conversations.repair_digests(frame.where("false")).count() == 0


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "user", "Hello?"), (2, 0, "assistant", "Yes.")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, copies bigint")
    report, repaired = conversations.repair_conversations(frame)
    assert {r.conv_id: (r.cost, r.audit) for r in report.collect()} == {1: (3, "KKR"), 2: (3, "IK")}
    assert [tuple(r) for r in repaired.where("conv_id = 1").collect()] == [
        (1, "K", "system", "Be kind."), (1, "K", "user", "Hi?"), (1, "R", "assistant", "Hello?")]
    assert [tuple(r)[1:] for r in repaired.where("conv_id = 2").collect()] == [("I", "user", ""), ("K", "assistant", "Yes.")]
