"""Conversation structure repair: the cheapest edits that give a conversation the role order (s?(ua)+)?.

Each row is kept (K, cost 0), given the role user or assistant (R, 1) or deleted (D, 2; a must for blank and repeated
rows), and user or assistant rows without text may be inserted anywhere (I, 5). A truncated row that is not deleted adds
5. Of the cheapest edits those count whose letters are least in ASCII order.

The choice is a shortest path over a graph without cycles: a node is a place between rows and a state of the role
order, an edge one edit. The weight of an edge is one integer: its high digits are the cost, below them stand digits of
fixed width, one for each place of the audit, with the letter's digit (D 1, I 2, K 3, R 4) at its place and zeros after
the end. The least integer is then the cheapest path with the least audit, so a plain minimum decides everything.

Two audits that have edited the same rows at the same cost never are one the start of the other, as what is left could
be inserts only, which cost. So the order of the paths that lead to the four states is settled at every row, and after a
block of rows their letters are written out and replaced by one digit, their rank. Integers stay short, and the work
grows with the rows, also in a conversation of millions of rows.

A conversation streams through one task, because its digest is one chain over its rows; the task holds one batch of
rows and a byte for each edit. Rows are dealt out and sorted by Spark, which spills; repeats are found by a window that
needs no exchange of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows between two settlements of the paths' order.
BLOCK = 64
#: Digits below the cost: a rank, three letters for a row at most (two inserts before it), two inserts at the end.
WIDTH = 1 + 3 * BLOCK + 2
DIGIT = 3  # bits
LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
_LETTER = {v: k for k, v in LETTERS.items()}
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: States of the role order: nothing yet, after s, after u, after a; what follows each, and with which role.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
LEGAL = {"su", "ua", "au"}
_WHITE = " \t\n\x0b\x0c\r"


def damage(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of conversations, damaged by crc32 of "conv_id:turn" modulo 20.

    0 drops the row (copies 0), 1 empties its text, 2 removes its [.!?], 3 repeats it (copies 2), 4 sets its role to
    user. Null roles and texts, and nulls in the key, are one space. Other columns are not read.
    """
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.pmod(F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")), F.lit(20))
    text = F.when(hit == 1, F.lit("")).when(hit == 2, F.regexp_replace(named("text"), "[.!?]", "")).otherwise(named("text"))
    return df.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(hit == 4, F.lit("user")).otherwise(named("role")).alias("role"),
        text.alias("text"), F.when(hit == 0, F.lit(0)).when(hit == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )


def _judged(df: DataFrame, *first: str) -> DataFrame:
    """The rows of each conversation in one partition, in order, with what is wrong with each; faultless texts only."""
    shown = F.rtrim(F.col("text"), F.lit(_WHITE))
    order = Window.partitionBy("conv_id", "role", "text").orderBy(F.desc(F.col("copies") > 0), F.asc_nulls_first("turn"))
    rows = df.repartition(F.col("conv_id")).withColumns({"blank": shown == "", "seen": F.row_number().over(order) > 1})
    rows = rows.withColumn("truncated", ~F.right(shown, F.lit(1)).isin(".", "!", "?"))
    rows = rows.sortWithinPartitions("conv_id", *first, F.asc_nulls_first("turn"), "role", "text", "seen")
    return rows.withColumn("text", F.when(~F.col("blank") & ~F.col("seen"), F.col("text")))


class Path:
    """The best way to a state: its weight, digits written since the last settlement, chain of letters before, digest."""

    __slots__ = ("weight", "length", "chain", "digest")

    def __init__(self, weight: int, length: int, chain: tuple | None, digest):
        self.weight, self.length, self.chain, self.digest = weight, length, chain, digest


def _step(weight: int, length: int, cost: int, letter: str) -> int:
    return weight + (cost << DIGIT * WIDTH) + (LETTERS[letter] << DIGIT * (WIDTH - 1 - length))


class Repair:
    """The edits of one conversation, row by row."""

    def __init__(self):
        self.paths = {START: Path(1 << DIGIT * (WIDTH - 1), 1, None, sha256())}
        self.rows = 0

    def _inserted(self) -> dict[int, tuple]:
        """For each state the best (weight, length, state before, rendered inserts), with two inserts here at most.

        A third would come back to a state that was there at less cost.
        """
        best = {q: (p.weight, p.length, q, ()) for q, p in self.paths.items()}
        for n in (0, 1):
            for q, (weight, length, origin, made) in list(best.items()):
                after, role = NEXT[q]
                way = (_step(weight, length, INSERT, "I"), length + 1, origin, (*made, f"{role}:".encode()))
                if len(made) == n and (after not in best or way[0] < best[after][0]):
                    best[after] = way
        return best

    def _move(self, best: dict[int, tuple]) -> None:
        paths = {}
        for q, (weight, length, origin, made) in best.items():
            old = self.paths[origin]
            digest = old.digest
            if made:
                digest = digest.copy()
                digest.update((b"" if origin == START else b"\n") + b"\n".join(made))
            paths[q] = Path(weight, length, old.chain, digest)
        self.paths = paths

    def _settled(self) -> None:
        """Writes the letters out and gives every path its rank among the audits as its first digit."""
        low = (1 << DIGIT * WIDTH) - 1
        for rank, p in enumerate(sorted(self.paths.values(), key=lambda p: p.weight & low), 1):
            p.chain = (p.chain, _letters(p.weight, p.length))
            p.weight, p.length = p.weight >> DIGIT * WIDTH << DIGIT * WIDTH | rank << DIGIT * (WIDTH - 1), 1
        self.rows = 0

    def add(self, role: str, text: str | None, truncated: bool) -> None:
        """One row; a text of None must be deleted."""
        best: dict[int, tuple] = {}
        initial, more = role[:1], TRUNCATED * truncated
        line = None if text is None else f":{text}".encode()

        def offer(q: int, way: tuple) -> None:
            if q not in best or way[0] < best[q][0]:
                best[q] = way

        for q, (weight, length, origin, made) in self._inserted().items():
            offer(q, (_step(weight, length, DELETE, "D"), length + 1, origin, made))
            if line is None:
                continue
            after, needed = NEXT[q]
            offer(after, (_step(weight, length, REROLE + more, "R"), length + 1, origin, (*made, needed.encode() + line)))
            if initial == needed[0] or initial == "s" and q == START:
                offer(after if initial == needed[0] else SYSTEM, (_step(weight, length, more, "K"), length + 1, origin, (*made, role.encode() + line)))
        self._move(best)
        self.rows += 1
        if self.rows == BLOCK:
            self._settled()

    def end(self) -> tuple[int, str, str]:
        """Cost, audit and digest of the cheapest repair."""
        self._move({q: way for q, way in self._inserted().items() if q in (START, ASSISTANT)})
        best = min(self.paths.values(), key=lambda p: p.weight)
        parts, chain = [_letters(best.weight, best.length)], best.chain
        while chain:
            chain, part = chain
            parts.append(part)
        return best.weight >> DIGIT * WIDTH, "".join(reversed(parts)), best.digest.hexdigest()


def _letters(weight: int, length: int) -> str:
    """The letters of a path since the last settlement; the first digit is a rank."""
    digits = weight >> DIGIT * (WIDTH - length) & (1 << DIGIT * (length - 1)) - 1
    return "".join(_LETTER[digits >> DIGIT * k & 7] for k in range(length - 2, -1, -1))


class Report:
    """What is said of one conversation."""

    def __init__(self, conv):
        self.conv, self.repair = conv, Repair()
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.low = self.high = self.last = None
        self.turns, self.initial = 0, None

    def add(self, turn, role: str, text: str | None, blank: bool, seen: bool, truncated: bool) -> None:
        if turn is not None:
            if turn != self.high:
                self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.initial = role[:1]
        fault = "blank" if blank else "duplicate" if seen else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        self.repair.add(role, None if blank or seen else text, truncated)

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.counts.values(), *self.repair.end())


_NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_READ = ["conv_id", "turn", "role", "text", "copies", "blank", "seen", "truncated"]


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_report, kind = None, None

    def batch(done: list[Report]) -> pa.RecordBatch:
        columns = list(zip(*(r.row() for r in done), strict=True)) or [[]] * len(_NAMES)
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _NAMES)

    for rows in batches:
        done, kind = [], rows.column(0).type
        for conv, turn, role, text, copies, blank, seen, truncated in zip(*(rows.column(n).to_pylist() for n in _READ), strict=True):
            if open_report is None or conv != open_report.conv:
                if open_report is not None:
                    done.append(open_report)
                open_report = Report(conv)
            for k in range(copies):
                open_report.add(turn, role, text, blank, seen or k > 0, truncated)
        yield batch(done)
    if open_report is not None:
        yield batch([open_report])


def repair(turns: DataFrame) -> DataFrame:
    """One row for each conversation of (conv_id, turn, role, text, copies) rows; those with copies 0 only name theirs.

    Columns: conv_id, gaps (turns missing between the least and the largest), blank, duplicate, truncated (rows by
    their first fault), illegal (neighbours whose role initials are not su, ua or au), cost and audit of the cheapest
    edits, repaired_sha256 of the repaired role:text lines.

    Rows stand in order of turn, nulls first, then role, then text; so equal rows stand together, and each but the
    first is a duplicate. A null conv_id is a conversation like any other. Roles and texts must not be null (damage()
    fills them). A conversation without rows has zeros, an empty audit and the digest of nothing; an empty table gives
    no rows. The audit has a byte for each row, so a conversation is bounded by what a cell of Spark may hold (2 GB).
    """
    schema = T.StructType([turns.schema["conv_id"], *[T.StructField(n, T.LongType()) for n in _NAMES[1:7]], *[T.StructField(n, T.StringType()) for n in _NAMES[7:]]])
    return _judged(turns.select(*_READ[:5])).select(*_READ).mapInArrow(_reports, schema)


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    audit, at, place, state = "", 0, 0, START
    for rows in batches:
        out: list[tuple] = []

        def emit(conv, role: str, text: str) -> None:
            nonlocal place, state
            out.append((conv, place, role, text))  # noqa: B023
            place, state = place + 1, SYSTEM if state == START and role[:1] == "s" else NEXT[state][0]

        def inserts(conv) -> None:
            nonlocal at
            while audit[at : at + 1] == "I":
                emit(conv, NEXT[state][1], "")  # noqa: B023
                at += 1

        for conv, header, role, text, copies in zip(*(rows.column(n).to_pylist() for n in ("conv_id", "header", "role", "text", "copies")), strict=True):
            if header is not None:
                audit, at, place, state = header, 0, 0, START
                inserts(conv)
            for _ in range(copies):
                letter = audit[at]
                at += 1
                if letter != "D":
                    emit(conv, NEXT[state][1] if letter == "R" else role, text)
                inserts(conv)
        columns = list(zip(*out, strict=True)) or [[]] * 4
        types = [rows.column(0).type, pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv_id", "place", "role", "text"])


def repaired(turns: DataFrame, reports: DataFrame) -> DataFrame:
    """The rows of the repaired conversations, (conv_id, place from 0, role, text), by the audits of repair(turns)."""
    headers = reports.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).alias("copies"), F.col("audit").alias("header"))
    both = headers.unionByName(turns.select(*_READ[:5]), allowMissingColumns=True).withColumn("later", F.col("header").isNull())
    schema = T.StructType([turns.schema["conv_id"], T.StructField("place", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    return _judged(both, "later").select("conv_id", "header", "role", "text", "copies").mapInArrow(_rendered, schema)
