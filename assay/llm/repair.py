"""Repair of damaged conversations by Wagner-Fischer alignment to an alternating grammar.

A well-formed conversation is empty, or pairs of a user's and an assistant's turn, after at most one
system turn: the role initials read ``(s?(ua)+)?``. Every feasible target is therefore an alternating
string, and all targets that end alike are suffixes of each other, so one table of edit costs, filled
from the end, aligns the turns to every feasible length. Only a band around equal length is filled,
as wide as the cheapest repair found so far allows (Ukkonen); the cheapest lengths are then
backtraced, and the audit that is least in ASCII wins.

Spark deals the rows by conversation and sorts them; a task reads them as a stream. A conversation is
aligned in segments of at most ``SEGMENT`` turns (fewer if their texts are long), between every pair of grammar states at the two
ends, and the segments are chained. Per state the chain holds a cost, what of its audit is not yet
certain, and the running hash of its repaired text, so texts never gather: a task holds a segment and
the certain audit, one byte a turn, which the result holds anyway.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import prepare, records

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SEGMENT, SEGMENT_BYTES = 512, 1 << 24
FIRST_BAND = 8
FAR = 1 << 28  # more than any cost of a segment

BLANKS = b" \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}

# States of the grammar: nothing yet, after a system, a user's, an assistant's turn.
NONE, SYSTEM, USER, ASSISTANT = "", "s", "u", "a"
STATES = (NONE, SYSTEM, USER, ASSISTANT)
FINAL = (NONE, ASSISTANT)
ROLES = {"u": b"user", "a": b"assistant"}

REPORT = """conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long,
    cost long, audit string, repaired_sha256 string"""


# Faults are passed on as one letter a turn: the role's initial (x: none of the grammar's), in upper
# case if the text is cut short, or d if the turn has to go.


def turn_code(role: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return "d"
    letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return letter.upper() if fault == "truncated" else letter


class _Table:
    """Costs from each turn of a segment to its end, for targets that end with ``last``.

    ``costs[i][k]``: turns from ``i`` on against the last ``q = n - i + k - deletes`` letters of the
    alternating string. ``system[i][k]``: the same with a system turn before these letters. One more
    delete than ``limit`` pays for is in the band, since that turn is not among the letters.
    """

    def __init__(self, codes: str, last: str, limit: int):
        n = len(codes)
        self.codes, self.last = codes, last
        self.deletes, self.inserts = limit // DELETE + 1, limit // INSERT
        width = self.deletes + self.inserts + 1
        offsets = np.arange(width) - self.deletes
        self.costs = np.full((n + 1, width), FAR, np.int64)
        self.system = np.full((n + 1, width), FAR, np.int64)
        steps = INSERT * np.arange(width)
        self.costs[n] = np.where(offsets >= 0, INSERT * offsets, FAR)
        for i in range(n - 1, -1, -1):
            q = n - i + offsets
            after = self.costs[i + 1]
            row = np.full(width, FAR, np.int64)
            row[:-1] = after[1:] + DELETE  # the same letters, one turn less
            same, other = self._moves(codes[i])
            match = np.where(self._is_first(q), same, other)
            np.minimum(row, after + match, out=row)
            row[q < 0] = FAR
            row = np.minimum(np.minimum.accumulate(row - steps) + steps, FAR)  # inserts
            self.costs[i] = row
            system = self.system[i, :-1]
            system[:] = self.system[i + 1, 1:] + DELETE
            if codes[i] in "sS":
                np.minimum(system, after[1:] + keep_cost(codes[i]), out=system)
            np.minimum(system, FAR, out=system)

    def _is_first(self, q: np.ndarray) -> np.ndarray:
        """Whether the letter before the last ``q - 1`` ones is a user's."""
        return (q % 2 == 0) == (self.last == "a")

    def _moves(self, code: str) -> tuple[int, int]:
        """Cost of a turn for a user's and for an assistant's letter."""
        if code == "d":
            return FAR, FAR
        extra = TRUNCATED if code.isupper() else 0
        letter = code.lower()
        return (
            (KEEP if letter == "u" else REROLE) + extra,
            (KEEP if letter == "a" else REROLE) + extra,
        )

    def letter(self, q: int) -> str:
        return "u" if (q % 2 == 0) == (self.last == "a") else "a"

    def cost(self, i: int, q: int, system: bool) -> int:
        k = q - (len(self.codes) - i) + self.deletes
        table = self.system if system else self.costs
        return int(table[i][k]) if q >= 0 and 0 <= k < table.shape[1] else FAR

    def audit(self, q: int, system: bool) -> str:
        """The least in ASCII of the cheapest edits: at each step the first letter that costs least."""
        i, out, codes = 0, [], self.codes
        while i < len(codes) or q > 0:
            here = self.cost(i, q, system)
            if i < len(codes) and self.cost(i + 1, q, system) + DELETE == here:
                out.append("D")
                i += 1
            elif not system and q > 0 and self.cost(i, q - 1, False) + INSERT == here:
                out.append("I")
                q -= 1
            elif system:
                out.append("K")
                i, system = i + 1, False
            else:
                out.append("K" if codes[i].lower() == self.letter(q) else "R")
                i, q = i + 1, q - 1
        return "".join(out)


def keep_cost(code: str) -> int:
    return KEEP + (TRUNCATED if code.isupper() else 0)


def _targets(entry: str, leave: str, longest: int) -> Iterable[tuple[int, bool]]:
    """(length, after a system turn) of every alternating target from one state to another."""
    if leave in (USER, ASSISTANT):
        if entry in (NONE, SYSTEM):
            first = 1 if leave == USER else 2
        else:
            first = 0 if entry == leave else 1
        yield from ((q, False) for q in range(first, longest + 1, 2))
        if entry == NONE:
            yield from ((q, True) for q in range(1 if leave == USER else 2, longest + 1, 2))


@lru_cache(maxsize=20_000)
def align(codes: str, pairs: tuple[tuple[str, str], ...]) -> dict[tuple[str, str], tuple[int, str]]:
    """Cheapest cost and least audit of a segment between each pair of states that can be joined."""
    n = len(codes)
    best: dict[tuple[str, str], tuple[int, str]] = {}
    for pair in pairs:
        entry, leave = pair
        if entry == leave and leave in (NONE, SYSTEM):
            best[pair] = (DELETE * n, "D" * n)
        elif pair == (NONE, SYSTEM):
            kept = [(keep_cost(c) + DELETE * (n - 1), i) for i, c in enumerate(codes) if c in "sS"]
            if kept:
                least = min(kept)[0]
                at = max(i for cost, i in kept if cost == least)
                best[pair] = (least, "D" * at + "K" + "D" * (n - 1 - at))
    for last in (USER, ASSISTANT):
        wanted = [p for p in pairs if p[1] == last]
        most = DELETE * n + 2 * INSERT  # every turn deleted, then at most two inserted
        limit = FIRST_BAND
        while wanted:
            limit = min(limit, most)
            table = _Table(codes, last, limit)
            longest = n + table.inserts
            costs = {
                pair: [(table.cost(0, q, s), q, s) for q, s in _targets(*pair, longest)]
                for pair in wanted
            }
            incumbents = {pair: min(costs[pair], default=(FAR,))[0] for pair in wanted}
            worst = max(incumbents.values())
            if worst > limit and limit < most:  # the band may have cut off something cheaper
                limit = worst if worst < FAR else 2 * limit
                continue
            for pair in wanted:
                cost = incumbents[pair]
                if cost < FAR:
                    level = [(q, s) for c, q, s in costs[pair] if c == cost]
                    best[pair] = (cost, min(table.audit(q, s) for q, s in level))
            break
    return best


class _History:
    """One way to have repaired a conversation so far."""

    def __init__(self, cost: int, audit: str, digest, first: bool):
        self.cost, self.audit, self.digest, self.first = cost, audit, digest, first


class Repair:
    """One conversation, whose turns are added in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.turn = None
        self.distinct = 0
        self.initial: str | None = None
        self.certain: list[str] = []
        self.ways = {NONE: _History(0, "", hashlib.sha256(), True)}
        self.codes: list[str] = []
        self.turns: list[tuple[bytes, bytes]] = []
        self.held = 0

    def add(self, turn: int | None, role: str, text: bytes, repeated: bool) -> None:
        if turn is not None and turn != self.turn:
            self.distinct += 1
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
        words = text.rstrip(BLANKS)
        fault = ""
        if not words:
            fault = "blank"
            self.blank += 1
        elif repeated:
            fault = "duplicate"
            self.duplicate += 1
        elif words[-1] not in b".!?":
            fault = "truncated"
            self.truncated += 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        if len(self.codes) == SEGMENT or self.held > SEGMENT_BYTES:
            self._settle(STATES)
        self.held += len(text)
        self.codes.append(turn_code(role, fault))
        self.turns.append((role.encode(), text))

    def _settle(self, leaves: tuple[str, ...]) -> None:
        """Align the segment, and keep for each state it can end in the best way there."""
        pairs = tuple((entry, leave) for entry in self.ways for leave in leaves)
        found = align("".join(self.codes), pairs)
        ways: dict[str, _History] = {}
        for leave in leaves:
            best = None
            for entry, before in self.ways.items():
                if (entry, leave) in found:
                    cost, audit = found[entry, leave]
                    way = (before.cost + cost, before.audit + audit, entry, audit)
                    best = way if best is None else min(best, way)
            if best is not None:
                ways[leave] = self._carried_out(self.ways[best[2]], best, best[2])
        self.ways, self.codes, self.turns, self.held = ways, [], [], 0
        known = commonprefix([w.audit for w in ways.values()])
        self.certain.append(known)
        for way in ways.values():
            way.audit = way.audit[len(known) :]

    def _carried_out(self, before: _History, best, state: str) -> _History:
        cost, audit, _, edits = best
        digest, first, i = before.digest.copy(), before.first, 0
        for edit in edits:
            if edit == "D":
                i += 1
                continue
            if edit == "K":
                role, text = self.turns[i]
                state = role[:1].decode()
            else:
                state = "a" if state == USER else "u"
                role, text = ROLES[state], b"" if edit == "I" else self.turns[i][1]
            i += edit != "I"
            digest.update(role + b":" + text if first else b"\n" + role + b":" + text)
            first = False
        return _History(cost, audit, digest, first)

    def report(self) -> tuple:
        self._settle(FINAL)
        way = min(self.ways.values(), key=lambda w: (w.cost, w.audit))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (
            self.conv_id,
            gaps,
            self.blank,
            self.duplicate,
            self.truncated,
            self.illegal,
            way.cost,
            "".join(self.certain) + way.audit,
            way.digest.hexdigest(),
        )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of a test of repair: some dropped, emptied, cut, repeated or given another role.

    What happens to a row depends on the crc32 of ``conv_id:turn`` alone. Nulls are one space.
    """

    def shown(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text, role = shown("text"), shown("role")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)).alias("copies"),
    )
    return rows.withColumn("copies", F.explode("copies")).drop("copies")


def repairs(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Faults and the cheapest repair of each conversation.

    ``turns`` has ``conv_id, turn, role, text``; ``conversations`` has the ``conv_id`` to report,
    repeats allowed, also those without a turn. Turns follow each other by number, null first; level
    ones by a hash of role and text. A null role or text is one space, a null ``conv_id`` is a
    conversation of its own, and further columns are passed over. A role that begins with no letter
    of the grammar, an empty one too, has to be changed or deleted. An empty table gives no row.

    A turn is a duplicate if its role and text occur earlier in its conversation, at whatever
    distance: the earlier occurrence is found by grouping hashes, and only the finding joins the
    sorted stream. A very long conversation is one task's stream, since the hash of its repaired text
    is sequential; a segment of it is held at a time.
    """
    prepare(turns.sparkSession)
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("ha"),
        F.xxhash64(F.lit(2), role, text).alias("hb"),
        role.alias("role"),
        text.alias("text"),
    )
    said = rows.select("conv_id", "turn", "ha", "hb").distinct()
    first = (
        said.groupBy(F.col("conv_id").alias("c"), F.col("ha").alias("a"), F.col("hb").alias("b"))
        .agg(F.min("turn").alias("least"), F.count("turn").alias("numbered"), F.count("*").alias("n"))
        .where("n > 1")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.expr("ha = a AND hb = b")
    later = "turn IS NOT NULL AND (numbered < n OR turn > least)"
    repeated = said.join(first, same).where(later).select("conv_id", "turn", "ha", "hb")

    listed = conversations.select(F.col("conv_id").cast("long").alias("conv_id"))
    listed = listed.union(said.select("conv_id")).distinct()
    stream = (
        rows.withColumn("kind", F.lit(2))
        .unionByName(repeated.withColumn("kind", F.lit(1)), allowMissingColumns=True)
        .unionByName(listed.withColumn("kind", F.lit(0)), allowMissingColumns=True)
        .withColumn("opens", F.col("kind") == 0)
        .repartition("conv_id")
        .sortWithinPartitions(
            "conv_id", F.desc("opens"), F.col("turn").asc_nulls_first(), "ha", "hb", "kind"
        )
        .select("conv_id", "turn", "ha", "hb", "kind", "role", F.col("text").cast("binary").alias("text"))
    )
    return stream.mapInArrow(_repaired, REPORT)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [(name, pa.string() if name in ("audit", "repaired_sha256") else pa.int64())
         for name in (part.split()[0] for part in REPORT.split(","))]
    )

    def batch(reports: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*reports), schema)], schema)

    now: Repair | None = None
    earlier = None  # (turn, hashes) of the last turn, or of a finding about the next ones
    reports: list[tuple] = []
    for part in records(batches):
        columns = [part.column(k).to_pylist() for k in range(part.num_columns)]
        for conv_id, turn, ha, hb, kind, role, text in zip(*columns):
            if kind == 0:
                if now is not None:
                    reports.append(now.report())
                now, earlier = Repair(conv_id), None
            elif kind == 1:
                earlier = (turn, ha, hb)
            else:
                this = (turn, ha, hb)
                now.add(turn, role, text, this == earlier)
                earlier = this
        if len(reports) >= 512:
            yield batch(reports)
            reports = []
    if now is not None:
        reports.append(now.report())
    if reports:
        yield batch(reports)
