"""Repair of conversations whose turns no longer alternate, by the cheapest edits.

Each conversation is searched depth first: an explicit stack of prefixes, a lower bound on what the rows that are left
must cost, the best (cost, audit) found so far, and for every node (rows read, place in the pattern) the best prefix that
reached it. A prefix goes when the bound lifts it over the best answer or a better prefix reached its node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a conversation that one search takes. A longer conversation is a chain of searches, see Conversation.
SEARCH_ROWS = 256

BLANKS = " \t\n\v\f\r"
STOPS = ".!?"
GOOD_PAIRS = {"su", "ua", "au"}
# Places in the pattern (s?(ua)+)?: nothing yet, after s, after u, after a
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
WANTED = ("u", "u", "a", "u")
REACHED = (USER, USER, ASSISTANT, USER)  # the place after what is wanted
ROLES = {"u": "user", "a": "assistant"}
REROLE = INSERT = 3
DELETE = 4
OPEN_END = 3  # what a truncated row costs unless it is deleted
FINE, TRUNCATED, UNUSABLE = range(3)
NO_WAY = 1 << 60

SUMMARY = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")
REPAIRED = "conv_id long, position long, edit string, role string, text string"


def least_costs(rows: list[tuple[str, int]], exits: tuple[int, ...], final: bool) -> list[list[int]]:
    """For every number of rows read and place in the pattern, what the rows that are left must cost at least to end in
    ``exits``: the costs alone, from the last row back, without regard to which edits give the least audit."""
    def with_insertions(costs: list[int]) -> list[int]:
        for _ in range(2):  # more than two in a row lead back to a place already passed
            costs = [min(c, INSERT + costs[REACHED[place]]) for place, c in enumerate(costs)]
        return costs

    costs = [0 if place in exits else NO_WAY for place in range(4)]
    bounds = [with_insertions(costs) if final else costs]
    for initial, fault in reversed(rows):
        after = bounds[-1]
        costs = [DELETE + c for c in after]
        if fault != UNUSABLE:
            stands = OPEN_END if fault == TRUNCATED else 0
            for place, wanted in enumerate(WANTED):
                edit = stands if initial == wanted else REROLE + stands
                costs[place] = min(costs[place], edit + after[REACHED[place]])
            if initial == "s":
                costs[START] = min(costs[START], stands + after[SYSTEM])
        bounds.append(with_insertions(costs))
    return bounds[::-1]


def search(rows: list[tuple[str, int]], entry: int, exits: tuple[int, ...], final: bool) -> tuple[int, str] | None:
    """The cheapest edits of ``rows`` (role initial, fault), ties by the least audit, from a place in the pattern to one
    of ``exits``; None where there is no way. Insertions behind the last row belong to the search with ``final``.

    Two prefixes at one node with equal costs have as many insertions and rows each, so neither begins the other, and
    the smaller stays smaller whatever follows: the table keeps one prefix per node.
    """
    n, bounds = len(rows), least_costs(rows, exits, final)
    best: tuple[int, str] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, place, cost, audit = stack.pop()
        least = cost + bounds[i][place]
        if least >= NO_WAY:
            continue
        if best is not None:
            if least > best[0] or (least == best[0] and audit > best[1][:len(audit)]):
                continue
        node = (i, place)
        if node in reached and reached[node] <= (cost, audit):
            continue
        reached[node] = (cost, audit)
        if i == n and place in exits and (best is None or (cost, audit) < best):
            best = (cost, audit)
        moves = []
        wanted, then = WANTED[place], REACHED[place]
        if i < n:
            initial, fault = rows[i]
            moves.append((DELETE + bounds[i + 1][place], "D", i + 1, place, DELETE))
            if fault != UNUSABLE:
                stands = OPEN_END if fault == TRUNCATED else 0
                if initial == wanted:
                    moves.append((stands + bounds[i + 1][then], "K", i + 1, then, stands))
                else:
                    moves.append((REROLE + stands + bounds[i + 1][then], "R", i + 1, then, REROLE + stands))
                    if initial == "s" and place == START:
                        moves.append((stands + bounds[i + 1][SYSTEM], "K", i + 1, SYSTEM, stands))
        if i < n or final:
            moves.append((INSERT + bounds[i][then], "I", i, then, INSERT))
        # what looks cheapest, and of that the least letter, is on top
        for _, letter, at, to, price in sorted(moves, reverse=True):
            stack.append((at, to, cost + price, audit + letter))
    return best


class Conversation:
    """One conversation, read row by row.

    Up to SEARCH_ROWS rows are one search. A longer conversation is searched piece by piece, from every place that a
    prefix has reached to every other; the best prefix per place is kept, and edits on which all of these agree are
    final: their rows are written and forgotten, so that memory follows the disagreement and not the length.
    """

    def __init__(self, conv_id: int | None, rows_too: bool):
        self.conv_id, self.rows_too = conv_id, rows_too
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = 0
        self.last_initial: str | None = None
        self.least = self.most = self.last_turn = None
        self.turns = 0
        self.seen: set[bytes] = set()
        self.open: list[tuple[str, str]] = []  # rows whose edit is not final
        self.searching: list[tuple[str, int]] = []
        self.fronts: dict[int, tuple[int, str]] = {START: (0, "")}
        self.audit: list[str] = []
        self.place, self.position = START, 0
        self.digest = hashlib.sha256()
        self.written: list[tuple] = []

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.last_turn
            self.most = self.last_turn = turn
        initial = role[:1]
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in GOOD_PAIRS
        self.last_initial = initial
        said = text.rstrip(BLANKS)
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        fault = FINE
        if not said:
            fault, kind = UNUSABLE, "blank"
        elif key in self.seen:
            fault, kind = UNUSABLE, "duplicate"
        elif said[-1] not in STOPS:
            fault, kind = TRUNCATED, "truncated"
        if fault:
            self.counts[kind] += 1
        self.seen.add(key)
        self.open.append((role, text))
        self.searching.append((initial, fault))
        if len(self.searching) >= SEARCH_ROWS:
            self._extend()

    def _extend(self) -> None:
        """Search the rows at hand from every front, and settle what all new fronts share."""
        rows, self.searching = self.searching, []
        found: dict[int, tuple[int, str]] = {}
        for entry, (cost, audit) in self.fronts.items():
            for exit_ in range(4):
                way = search(rows, entry, (exit_,), final=False)
                if way is not None:
                    whole = (cost + way[0], audit + way[1])
                    found[exit_] = min(found.get(exit_, whole), whole)
        audits = [audit for _, audit in found.values()]
        low, high = min(audits), max(audits)
        shared = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        self._settle(low[:shared])
        self.fronts = {place: (cost, audit[shared:]) for place, (cost, audit) in found.items()}

    def _write(self, edit: str, role: str, text: str) -> None:
        line = f"{role}:{text}"
        self.digest.update(("\n" if self.position else "").encode() + line.encode())
        if self.rows_too:
            self.written.append((self.conv_id, self.position, edit, role, text))
        self.position += 1

    def _settle(self, edits: str) -> None:
        """Carry out edits that are final."""
        done = 0
        for edit in edits:
            wanted = WANTED[self.place]
            if edit == "I":
                self._write(edit, ROLES[wanted], "")
                self.place = REACHED[self.place]
                continue
            role, text = self.open[done]
            done += 1
            if edit == "D":
                continue
            system = edit == "K" and role[:1] == "s"
            self._write(edit, ROLES[wanted] if edit == "R" else role, text)
            self.place = SYSTEM if system else REACHED[self.place]
        del self.open[:done]
        self.audit.append(edits)

    def finish(self) -> tuple:
        rows, self.searching = self.searching, []
        ways = [(cost + way[0], audit + way[1]) for entry, (cost, audit) in self.fronts.items()
                if (way := search(rows, entry, ENDS, final=True)) is not None]
        cost, edits = min(ways)
        self._settle(edits)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.conv_id, gaps, self.counts["blank"], self.counts["duplicate"], self.counts["truncated"],
                self.illegal, cost, "".join(self.audit), self.digest.hexdigest())


def _repaired(conversations: DataFrame, schema: str, rows_too: bool, absent: str | None) -> DataFrame:
    kinds = [pa.string() if part.endswith("string") else pa.int64() for part in schema.split(", ")]
    names = [part.split(" ")[0] for part in schema.split(", ")]

    def table_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: Conversation | None = None
        for batch in batches:
            out: list[tuple] = []
            for conv_id, turn, role, text, gone in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or conv_id != current.conv_id:
                    if current is not None:
                        summary = current.finish()
                        out += current.written if rows_too else [summary]
                    current = Conversation(conv_id, rows_too)
                if not gone:
                    current.add(turn, role, text)
            if rows_too and current is not None:
                out += current.written
                current.written = []
            if out:
                yield table_of(out)
        if current is not None:
            summary = current.finish()
            if out := (current.written if rows_too else [summary]):
                yield table_of(out)

    gone = F.coalesce(F.col(absent), F.lit(False)) if absent else F.lit(False)
    space = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"), gone.alias("gone"))
    ordered = rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.mapInArrow(run, schema)


def repair(conversations: DataFrame, absent: str | None = None) -> DataFrame:
    """One row of SUMMARY per conversation of ``conv_id, turn, role, text``: faults, cost, audit and what it became.

    Rows are taken by turn, null turns first, equal turns by role and text. A null role or text counts as one space; null
    conversation ids are one conversation. Rows where the column ``absent`` holds only say that their conversation is
    there; one without other rows has zeros, an empty audit and the hash of nothing. Rows that repeat are duplicates. An
    empty table gives no rows; other columns are not read. The hash of a conversation is one pass over its text, so a
    conversation is read by one task, as a stream: texts are let go as soon as their edit is final.
    """
    return _repaired(conversations, SUMMARY, False, absent)


def repaired_rows(conversations: DataFrame, absent: str | None = None) -> DataFrame:
    """The rows of REPAIRED that `repair` hashes, one by one: kept, reroled and inserted ones, numbered from 0."""
    return _repaired(conversations, REPAIRED, True, absent)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` as a transfer may leave them, with a column ``dropped``: of 20 kinds of rows, told apart by the
    CRC-32 of id and turn, one is dropped, one emptied, one loses its stops, one comes twice, and one turns to user."""
    def written(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(written("conv_id"), F.lit(":"), written("turn")).cast("binary")) % 20
    text = (F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(written("text"), "[.!?]", ""))
            .otherwise(written("text")))
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("_kind", kind).select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(written("role")).alias("role"),
        F.when(F.col("_kind") != 0, text).alias("text"), (F.col("_kind") == 0).alias("dropped"), "_kind")
    times = F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("_time", F.explode(times)).drop("_kind", "_time")
