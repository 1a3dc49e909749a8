"""Operator 13: the cheapest edits that give conversations a sound structure, by the auction algorithm for shortest paths.

A conversation is a lattice: (rows behind us, role last put out), with an arc for every edit. Keeping a row costs nothing, giving it
the role that is due 3, deleting it 4, inserting an empty turn 3; a truncated row that stays costs 3 more, a blank or repeated row
must go. The auction holds a price per node and a path from the start. At the path's end node, if the price is below the least of
arc cost + price of the arc's head, it rises to that and the path gives the node up; otherwise the path grows along that arc, until
it reaches the goal. Costs are whole numbers, so it ends, and prices never exceed the true distance to the goal. Then every arc of
every cheapest path is tight (price = cost + price of its head), and the least edit string is read off along tight arcs from which
tight arcs lead to the goal.

Prices rise in small steps, so a long lattice is cut into blocks of ``BLOCK`` rows: from the last block to the first, the prices of
a block's four entry nodes become the costs of leaving the block before. Work is thus linear in the rows of a conversation, and equal
blocks are solved once per worker.

Spark collapses equal rows before it shuffles them, marks first occurrences, and orders rows; texts are never held but one Arrow batch
at a time. The lattice needs one byte a row, no more than the edit string that is returned as one value. A conversation is hashed by
the task that reads its rows in order, since a SHA-256 is one chain; whatever its size it is streamed, not collected.

Cases: null roles and texts are one space, null turns come first, rows of equal turn are ordered by role and text; the rows without
a conversation id are one conversation; repeated rows are repetitions. A role outside system, user and assistant (by initial) can
only be changed or deleted. Gaps beyond a long are the greatest long. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from linecross.llm.common import byte_slices, stage

BLOCK = 32
KEEP, DELETE, REROLE, INSERT, TRUNCATED = 0, 4, 3, 3, 3
#: States by what was put out last: nothing, system, user, assistant. The role that is due next, as a state.
NEXT = (2, 2, 3, 2)
ROLES = (None, "system", "user", "assistant")
_SPACE = " \t\n\x0b\x0c\r"
REPORT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
REPAIRED = "conv_id bigint, edit string, role string, text string"
#: Rows as letters: a role's initial (``-`` for others), in upper case (``_``) if truncated; ``.`` if the row must go.
Codes = str


def damaged_turns(turns: DataFrame) -> DataFrame:
    """Rows with the faults that their key draws, with how many ``copies`` of each there are."""
    key = "crc32(concat(coalesce(cast(conv_id AS string), ' '), ':', coalesce(cast(turn AS string), ' '))) % 20"
    return turns.selectExpr("conv_id", "turn", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text", f"{key} AS _key").where(
        "_key <> 0").selectExpr(
        "conv_id", "turn", "CASE _key WHEN 4 THEN 'user' ELSE role END AS role",
        "CASE _key WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text",
        "CASE _key WHEN 3 THEN 2L ELSE 1L END AS copies")


def marked_turns(turns: DataFrame) -> DataFrame:
    """Rows in order (``pos`` from 1), equal ones as one with ``copies``, with the ``fault`` of the first copy and the role's initial."""
    alike = turns.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).repartition("conv_id")
    order = [F.asc_nulls_first("turn"), "role", "text"]
    told = alike.withColumn("_nth", F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn")))
                            ).withColumn("pos", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)))
    return told.withColumn("_end", F.expr(f"right(trim(TRAILING '{_SPACE}' FROM text), 1)")).selectExpr(
        "conv_id", "turn", "pos", "role", "text", "copies",
        "CASE WHEN _end = '' THEN 'blank' WHEN _nth > 1 THEN 'duplicate' WHEN _end NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault",
        "CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '-' END AS initial")


def _lattice(codes: Codes, exits: tuple[int | None, ...], last: bool) -> list[list[tuple[str, int, int]]]:
    """Arcs (letter, cost, head) of node ``4 * row + state``; the goal is the node behind all."""
    goal, arcs = 4 * (len(codes) + 1), []
    for at in range(len(codes) + 1):
        for state in range(4):
            here = []
            if at < len(codes):
                below, code = 4 * (at + 1), codes[at]
                here.append(("D", DELETE, below + state))
                if code != ".":
                    more = TRUNCATED if code.isupper() or code == "_" else 0
                    kept = "-sua".find(code.lower())
                    if kept > 0 and (kept == NEXT[state] or kept == 1 and state == 0):
                        here.append(("K", KEEP + more, below + kept))
                    here.append(("R", REROLE + more, below + NEXT[state]))
            elif exits[state] is not None:
                here.append(("", exits[state], goal))
            if at < len(codes) or last:
                here.append(("I", INSERT, 4 * at + NEXT[state]))
            arcs.append(here)
    return arcs


def auction(arcs: list[list[tuple[str, int, int]]], origins: list[int]) -> list[int]:
    """Prices of all nodes; those of the origins are their exact distances to the goal, the node behind the last."""
    goal = len(arcs)
    price = [0] * (goal + 1)
    for origin in origins:
        path = [origin]
        while (node := path[-1]) != goal:
            least, head = min((cost + price[head], head) for _, cost, head in arcs[node])
            if price[node] < least:
                price[node] = least
                if node != origin:
                    path.pop()
            else:
                path.append(head)
    return price


def least_string(arcs: list[list[tuple[str, int, int]]], price: list[int], origin: int) -> tuple[str, int]:
    """The least letters of a path of tight arcs from ``origin``, and the node before the goal."""
    goal = len(arcs)

    def tight(node: int) -> list[tuple[str, int]]:
        return sorted((letter, head) for letter, cost, head in arcs[node] if price[node] == cost + price[head])
    # Depth first in the order of letters: the first way to the goal is the least, since nodes given up lead nowhere.
    stack, letters, left = [(origin, iter(tight(origin)))], [], {origin}
    while True:
        node, ways = stack[-1]
        for letter, head in ways:
            if head == goal:
                return "".join(letters), node
            if head not in left:
                left.add(head)
                letters.append(letter)
                stack.append((head, iter(tight(head))))
                break
        else:
            stack.pop()
            letters.pop()


@lru_cache(maxsize=1 << 15)
def solved_block(codes: Codes, exits: tuple[int | None, ...], last: bool) -> tuple[tuple[int, ...], tuple[tuple[str, int], ...]]:
    """For each state on entry: the distance to the goal, the least letters inside the block, and the state on leaving it."""
    arcs = _lattice(codes, exits, last)
    price = auction(arcs, [0, 1, 2, 3])
    ways = [least_string(arcs, price, state) for state in range(4)]
    return tuple(price[:4]), tuple((letters, node - 4 * len(codes)) for letters, node in ways)


def cheapest_edits(codes: Codes, block: int = BLOCK) -> tuple[int, str]:
    """Cost and least edit string of a conversation."""
    parts = [codes[k:k + block] for k in range(0, len(codes), block)] or [""]
    exits, total, ways = (0, None, None, 0), 0, []
    for n, part in enumerate(reversed(parts)):
        prices, way = solved_block(part, exits, n == 0)
        ways.append(way)
        # Less the least of them, so that equal blocks have equal costs of leaving.
        total += min(prices)
        exits = tuple(p - min(prices) for p in prices)
    cost, state, letters = total + exits[0], 0, []
    for way in reversed(ways):
        found, state = way[state]
        letters.append(found)
    return cost, "".join(letters)


class _Report:
    """Figures of one conversation, row by row."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.counts, self.illegal = conv_id, dict.fromkeys(("blank", "duplicate", "truncated"), 0), 0
        self.codes: list[str] = []
        self.before = self.low = self.high = None
        self.turns = 0

    def add(self, turn: int | None, initial: str, fault: str, copies: int) -> None:
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        first = {"sound": initial, "truncated": "_" if initial == "-" else initial.upper()}.get(fault, ".")
        self.codes.append(first + "." * (copies - 1))
        for name, n in ((fault, 1), ("blank" if fault == "blank" else "duplicate", copies - 1)):
            if name != "sound":
                self.counts[name] += n
        self.illegal += (self.before is not None and self.before + initial not in ("su", "ua", "au")) + (copies - 1)
        self.before = initial

    def row(self) -> tuple:
        cost, audit = cheapest_edits("".join(self.codes))
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        return self.conv_id, gaps, *self.counts.values(), self.illegal, cost, audit


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if kind == "bigint" else pa.string()) for c, (_, kind) in zip(columns, fields)],
                                      [name for name, _ in fields])


def structure_report(marked: DataFrame) -> DataFrame:
    """Faults, least cost and edits of every conversation that has rows; only a few bytes a row are read and shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []
        for batch in batches:
            for conv_id, _, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        done.append(current.row())
                    current = _Report(conv_id)
                current.add(*row)
            if len(done) >= 1000:
                yield _batch(done, REPORT)
                done = []
        if current is not None:
            yield _batch([*done, current.row()], REPORT)

    return marked.select("conv_id", "pos", "turn", "initial", "fault", "copies").repartition("conv_id").sortWithinPartitions(
        "conv_id", "pos").mapInArrow(run, REPORT)


def repaired_turns(marked: DataFrame, report: DataFrame) -> DataFrame:
    """The turns that stay or are added, a conversation's in order and together: ``conv_id, edit, role, text``.

    The edits go ahead of a conversation's rows as a row with place 0, so that rows are read once and in order.
    """
    both = report.selectExpr("conv_id", "0 AS pos", "'' AS role", "audit AS text", "1L AS copies").unionByName(
        marked.select("conv_id", "pos", "role", "text", "copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, edits, at, state = None, "", 0, 0

        def inserted() -> list[tuple]:
            nonlocal at, state
            out = []
            while edits[at:at + 1] == "I":
                at, state = at + 1, NEXT[state]
                out.append((conv_id, "I", ROLES[state], ""))
            return out

        for batch in batches:
            for part in byte_slices(batch, "text"):
                out = []
                for owner, pos, role, text, copies in zip(*(c.to_pylist() for c in part.columns)):
                    if pos == 0:
                        out += inserted()
                        conv_id, edits, at, state = owner, text, 0, 0
                        continue
                    for _ in range(copies):
                        out += inserted()
                        edit, at = edits[at], at + 1
                        if edit != "D":
                            state = NEXT[state] if edit == "R" or role[:1] != "s" else 1
                            out.append((owner, edit, ROLES[state] if edit == "R" else role, text))
                if out:
                    yield _batch(out, REPAIRED)
        if rest := inserted():
            yield _batch(rest, REPAIRED)

    return both.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(run, REPAIRED)


def _hashes(repaired: DataFrame) -> DataFrame:
    """SHA-256 of ``role:text`` lines; reads the rows in the order in which ``repaired_turns`` gives them, with no shuffle between."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, digest = None, None
        for batch in batches:
            done = []
            for owner, _, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if digest is None or owner != conv_id:
                    if digest is not None:
                        done.append((conv_id, digest.hexdigest()))
                    conv_id, digest = owner, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            yield _batch(done, "conv_id bigint, repaired_sha256 string")
        if digest is not None:
            yield _batch([(conv_id, digest.hexdigest())], "conv_id bigint, repaired_sha256 string")
    return repaired.mapInArrow(run, "conv_id bigint, repaired_sha256 string")


def repair_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Report per conversation and repaired turns of ``conv_id, turn, role, text, copies``, both from staged tables."""
    marked = stage(marked_turns(turns), "turns")
    report = stage(structure_report(marked), "report")
    return report, repaired_turns(marked, report)


def repair_digests(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns``: the faults after damage, the least edits, and a hash of what they give."""
    report, repaired = repair_conversations(damaged_turns(turns))
    hashes = _hashes(repaired)
    known = turns.select(F.col("conv_id").alias("_id")).distinct()
    told = known.join(report, F.col("_id").eqNullSafe(report["conv_id"]), "left").drop("conv_id")
    told = told.join(hashes, F.col("_id").eqNullSafe(hashes["conv_id"]), "left").drop("conv_id")
    return told.selectExpr("_id AS conv_id", *[f"coalesce({c}, 0L) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                           "coalesce(audit, '') AS audit", "coalesce(repaired_sha256, sha2('', 256)) AS repaired_sha256")
