"""Conversation repair by Wagner-Fischer alignment to the alternating grammar.

A conversation may have one system turn and then pairs of a user and an assistant turn: its role initials
match ``(s?(ua)+)?``. Its turns are aligned with each feasible target string of this grammar: a turn is
kept or rerolled where it stands for a target letter, or deleted, and a letter without a turn is inserted.
All targets without a system turn are ends of one alternating string, so one edit-distance table (turns
left by letters left) serves every length; a target with a system turn is such an end behind one kept
turn. The table is filled inside Ukkonen bands: an incumbent (the cost of a plain left-to-right repair)
bounds how far turns left and letters left may differ, as each surplus turn costs a deletion and each
surplus letter an insertion. The cheapest targets are backtraced, in each step by the least edit initial,
and their audits compared.

Long conversations are aligned in pieces of PIECE turns: for each role that the piece before may have
ended with, and each that it may end with itself, the cheapest edits of the piece; costs are added and
the least audits joined, so tables are bounded by a piece and the result is that of one table. (Equally
dear audits of a piece are never the beginning of one another, so the least audit of the whole is joined
from least audits.) Spark deals conversations out by their id and sorts the turns (spilling to disk); a task
streams through them and holds, besides a piece, sixteen bytes a turn, the audit, and running hashes: a
conversation's texts are never held together. Its SHA-256, a sequential hash, needs one task to read it.

Null conv_ids are one conversation. Null turns come first and are in no gap. Null roles and texts are one
space. Turns that repeat a number are ordered by role and text. Texts of any length are taken whole; extra
columns are ignored. An empty table gives no rows, a conversation without turns zeros."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_lake.llm.common import modest_batches

#: Contract values: one in DAMAGE of the turns suffers each of five damages; costs of the edits.
DAMAGE = 20
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Turns aligned by one table.
PIECE = 256

SPACE = " \t\n\x0b\x0c\r"
ROLE = {"u": "user", "a": "assistant"}
OTHER = {"u": "a", "a": "u"}
#: Letter that a target goes on with, by the letter it has so far ("": none).
NEXT = {"": "u", "s": "u", "a": "u", "u": "a"}
_FAR = 1 << 28


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, dropped`` with nulls replaced; other columns go no further."""
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), F.lit(False).alias("dropped"))


def damage(conversations: DataFrame, one_in: int = DAMAGE) -> DataFrame:
    """Turns as ``turns`` gives them, some of them damaged by a hash of conversation and turn: dropped
    (marked, so that its conversation is still known), emptied, without final marks, doubled, rerolled."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))), F.lit(one_in))
    hurt = turns(conversations).withColumn("kind", kind)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return hurt.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("dropped"), copies.alias("copy")).drop("copy")


class Turn:
    """A turn as the alignment sees it: role initial, first fault, role, text."""

    __slots__ = ("initial", "fault", "role", "text", "forced", "extra")

    def __init__(self, role: str, text: str, seen: set):
        self.role, self.text, self.initial = role, text, role[:1]
        end = text.rstrip(SPACE)
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        self.fault = "blank" if not end else "duplicate" if key in seen else "truncated" if end[-1] not in ".!?" else ""
        seen.add(key)
        self.forced = self.fault in ("blank", "duplicate")
        self.extra = TRUNCATED if self.fault == "truncated" else 0


def incumbent(piece: list[Turn], last: str, end: str) -> int:
    """Cost of a plain repair from one letter to another: it bounds the cheapest cost from above."""
    cost, now = 0, last
    for t in piece:
        if t.forced or t.extra:
            cost += DELETE
        else:
            now = NEXT[now]
            cost += KEEP if t.initial == now else REROLE
    while now != end or now == last == "":
        now = NEXT[now]
        cost += INSERT
    return cost


class Table:
    """Least cost of aligning the turns from each place on with the last letters of an alternating string
    that ends with ``end``, where it is ``bound`` at most."""

    def __init__(self, piece: list[Turn], end: str, bound: int):
        self.piece, self.end, self.bound = piece, end, bound
        n = len(piece)
        forced = np.cumsum([0, *[t.forced for t in reversed(piece)]])[::-1]  # among the turns left
        free = np.arange(n, -1, -1) - forced
        room = bound - DELETE * forced
        low = np.maximum(free - room // DELETE, 0)
        high = free + np.maximum(room, -1) // INSERT
        self.width = int(max(high.max(), 0)) + 1
        letters = np.arange(self.width)
        dear = INSERT * letters
        odd = letters % 2 == 1
        self.cost = np.full((n + 1, self.width), _FAR, np.int64)
        self.cost[n, :] = np.where(dear <= bound, dear, _FAR)
        for i in range(n - 1, -1, -1):
            a, b = int(low[i]), min(int(high[i]), self.width - 1) + 1
            if room[i] < 0 or a >= b:
                continue
            after, t = self.cost[i + 1], piece[i]
            best = after[a:b] + DELETE
            if not t.forced:
                fits = odd if t.initial == end else ~odd if t.initial == OTHER[end] else np.zeros(self.width, bool)
                k = max(a, 1)
                stay = after[k - 1:b - 1] + np.where(fits[k:b], KEEP, REROLE) + t.extra
                best[k - a:] = np.minimum(best[k - a:], stay)
            best = np.minimum.accumulate(best - dear[a:b]) + dear[a:b]
            self.cost[i, a:b] = np.minimum(best, _FAR)

    def letter(self, left: int) -> str:
        return self.end if left % 2 else OTHER[self.end]

    def lengths(self, i: int, first: str) -> list[tuple[int, int]]:
        """(cost, letters) of the ends that begin with a letter, for the turns from ``i`` on."""
        start = 1 if self.letter(1) == first else 2
        row = self.cost[i]
        return [(int(row[r]), r) for r in range(start, self.width, 2) if row[r] <= self.bound]

    def audit(self, i: int, left: int) -> str:
        """Edit initials of the cheapest alignment, in each step the least."""
        out, cost, n = [], self.cost, len(self.piece)
        while i < n or left:
            now = cost[i, left]
            if i < n and cost[i + 1, left] + DELETE == now:
                out.append("D")
                i += 1
            elif left and cost[i, left - 1] + INSERT == now:
                out.append("I")
                left -= 1
            else:
                out.append("K" if self.piece[i].initial == self.letter(left) else "R")
                i, left = i + 1, left - 1
        return "".join(out)


def aligned(piece: list[Turn], before: list[str], ends: list[str]) -> dict[tuple[str, str], tuple[int, str]]:
    """(last letter before, last letter) -> least (cost, audit) of a piece's edits."""
    n, found = len(piece), {}

    def better(key, cost: int, audit) -> None:
        have = found.get(key)
        if have is None or cost < have[0]:
            found[key] = (cost, audit())
        elif cost == have[0]:
            found[key] = (cost, min(have[1], audit()))

    openers = [i for i, t in enumerate(piece) if t.initial == "s" and not t.forced] if "" in before else []
    for last in before:  # nothing added
        better((last, last), DELETE * n, lambda: "D" * n)
    for i in openers:
        better(("", "s"), DELETE * (n - 1) + piece[i].extra, lambda i=i: "D" * i + "K" + "D" * (n - 1 - i))
    for end in ends:
        table = Table(piece, end, max(incumbent(piece, last, end) for last in before))
        for last in before:
            lengths = table.lengths(0, NEXT[last])
            least = min(lengths, default=(0, 0))[0]
            for cost, left in lengths:
                if cost == least:
                    better((last, end), cost, lambda left=left: table.audit(0, left))
        for i in openers:
            head = DELETE * i + piece[i].extra
            lengths = table.lengths(i + 1, "u") if head <= table.bound else []
            least = min(lengths, default=(0, 0))[0]
            for cost, left in lengths:
                if cost == least and head + cost <= table.bound:
                    better(("", end), head + cost, lambda i=i, left=left: "D" * i + "K" + table.audit(i + 1, left))
    return found


def edited(piece: list[Turn], last: str, audit: str) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that an audit leaves, behind a letter."""
    rest = iter(piece)
    for edit in audit:
        turn = next(rest) if edit != "I" else None
        if edit == "D":
            continue
        if edit == "K":
            last = turn.initial
            yield edit, turn.role, turn.text
        else:
            last = NEXT[last]
            yield edit, ROLE[last], turn.text if turn else ""


class Conversation:
    """Running repair of one conversation; turns are added in order."""

    def __init__(self, conv_id):
        self.conv_id, self.seen, self.piece = conv_id, set(), []
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal, self.initial = 0, None
        self.first = self.last = None
        self.distinct = 0
        # By the last letter so far: cost, audit, hash of the repaired turns.
        self.best = {"": (0, "", hashlib.sha256())}

    def add(self, turn, role: str, text: str) -> None:
        t = Turn(role, text, self.seen)
        if t.fault:
            self.faults[t.fault] += 1
        if self.initial is not None and self.initial + t.initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = t.initial
        if turn is not None and turn != self.last:
            self.first, self.last, self.distinct = turn if self.first is None else self.first, turn, self.distinct + 1
        if len(self.piece) == PIECE:
            self._advance(["u", "a"])
        self.piece.append(t)

    def _advance(self, ends: list[str]) -> None:
        found, best = aligned(self.piece, list(self.best), ends), {}
        for (before, end), (cost, audit) in found.items():
            rank = (self.best[before][0] + cost, self.best[before][1] + audit)
            if end not in best or rank < best[end][0]:
                best[end] = (rank, before, audit)
        out = {}
        for end, (rank, before, audit) in best.items():
            digest, empty = self.best[before][2].copy(), before == ""
            for _, role, text in edited(self.piece, before, audit):
                digest.update((f"{role}:{text}" if empty else f"\n{role}:{text}").encode())
                empty = False
            out[end] = (*rank, digest)
        self.best, self.piece = out, []

    def result(self) -> tuple:
        if self.piece:
            self._advance(["a"])
        cost, audit, digest = min((self.best[e] for e in ("", "a") if e in self.best), key=lambda b: b[:2])
        gaps = self.last - self.first + 1 - self.distinct if self.distinct else 0
        return self.conv_id, gaps, *self.faults.values(), self.illegal, cost, audit, digest.hexdigest()


SCHEMA = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def _in_turn(rows: DataFrame, *first) -> DataFrame:
    """Every conversation whole in one partition, its turns in order (behind the rows that ``first`` puts first)."""
    return modest_batches(rows).repartition("conv_id").sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "role", "text")


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and hash of the repaired turns (``SCHEMA``) for every conversation among the
    rows (as ``turns`` or ``damage`` give them)."""
    def run(batches: Iterator):
        import pyarrow as pa

        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        table = lambda done: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
        now = None
        for batch in batches:
            done = []
            for conv_id, turn, role, text, dropped in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.result())
                    now = Conversation(conv_id)
                if not dropped:
                    now.add(turn, role, text)
            if done:
                yield table(done)
        if now is not None:
            yield table([now.result()])

    return _in_turn(rows.select("conv_id", "turn", "role", "text", "dropped")).mapInArrow(run, SCHEMA)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, place, role, text, edit`` (place from 0, edit K, R or I)."""
    audits = repair(rows).select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(True).alias("is_audit"))
    both = rows.where(~F.col("dropped")).select("conv_id", "turn", "role", "text", F.lit(False).alias("is_audit")).unionByName(audits)

    def run(batches: Iterator):
        import pyarrow as pa

        kinds, names = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()], ["conv_id", "place", "role", "text", "edit"]
        conv, edits, place, last = None, iter(""), 0, ""

        def up_to(turn) -> Iterator[tuple]:
            """Insertions and then the edit of a turn (role, text); for None the insertions at the end."""
            nonlocal place, last
            for edit in edits:
                if edit != "D":
                    last = turn[0][:1] if edit == "K" else NEXT[last]
                    yield conv, place, turn[0] if edit == "K" else ROLE[last], turn[1] if edit != "I" else "", edit
                    place += 1
                if edit != "I":
                    return

        def table(out: list):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for batch in batches:
            out = []
            for conv_id, _, role, text, is_audit in zip(*(c.to_pylist() for c in batch.columns)):
                if is_audit:
                    out += up_to(None)
                    conv, edits, place, last = conv_id, iter(text), 0, ""
                else:
                    out += up_to((role, text))
            if out:
                yield table(out)
        out = list(up_to(None))
        if out:
            yield table(out)

    return _in_turn(both, F.col("is_audit").desc()).mapInArrow(run, "conv_id long, place long, role string, text string, edit string")


def digest(conversations: DataFrame) -> DataFrame:
    """Contract columns of the registered query: the damaged conversations, repaired."""
    return repair(damage(conversations))
