"""Repair of damaged conversations by a run-length dynamic programme.

A conversation's rows become symbols, the role's initial with the first fault, and equal
neighbours one run. Edits move between four states (at the start, after a system, a user or an
assistant row), so a row is a min-plus matrix of the costs from state to state, insertions
before it included, and a run a power of it, formed of cached binary powers. The costs to the
end are carried back over runs in that way; then the rows of each run choose their edits in order.

Rows are dealt by ranges of (conversation, turn, role, text), so a conversation of any length
spreads over tasks, which look for faults and form runs. One task then takes a conversation's
runs and passes once over its rows in order, since the audit is one value and a SHA-256 is
formed in sequence; it holds the runs and the audit, never the texts.

Defined cases: a null role or text is one space, as is a null id or turn in the text whose CRC
decides on the damage; rows with a null conversation are one conversation; null turns come
first; rows of one turn follow each other by role and text (after damage), equal rows next to
each other; very long texts are whole; a conversation that loses all its rows has zeros and an
empty audit; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm.common import shuffle_partitions, stored, table

#: States by what came before, and the state that an inserted or reroled row leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
DELETED, INSERTED, REROLED, CUT_OFF = 2, 5, 1, 5
END = (0, 2 * INSERTED, INSERTED, 0)
NEVER = 1 << 60
#: Rows of a run whose costs are held at once.
BLOCK = 1024
#: A row that has to go; others are the role's initial (o: none of the three), in upper case if cut off.
GONE = "x"


def edits(symbol: str) -> list[list[tuple[str, int, int]]]:
    """For each state the edits of a row: (letter, cost, next state), in ASCII order."""
    found = []
    for state in range(4):
        own = [("D", DELETED, state)]
        if symbol != GONE:
            more = CUT_OFF if symbol.isupper() else 0
            if state in (kept := KEEP.get(symbol.lower(), {})):
                own.append(("K", more, kept[state]))
            own.append(("R", REROLED + more, STEP[state]))
        found.append(own)
    return found


@functools.cache
def power(symbol: str, k: int) -> tuple[tuple[int, ...], ...]:
    """Least costs from state to state over 2**k rows of a symbol."""
    if k:
        half = power(symbol, k - 1)
        return tuple(tuple(min(row[m] + half[m][t] for m in range(4)) for t in range(4)) for row in half)
    own = edits(symbol)
    matrix = [[NEVER] * 4 for _ in range(4)]
    for state in range(4):
        at, spent = state, 0
        for _ in range(4):
            for _, cost, then in own[at]:
                matrix[state][then] = min(matrix[state][then], spent + cost)
            at, spent = STEP[at], spent + INSERTED
    return tuple(map(tuple, matrix))


def before(symbol: str, n: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to the end before n rows of a symbol, from those after them."""
    k = 0
    while n:
        if n & 1:
            costs = tuple(min(row[t] + costs[t] for t in range(4)) for row in power(symbol, k))
        n, k = n >> 1, k + 1
    return costs


def repair(runs: list[tuple[str, int]]) -> tuple[int, str]:
    """The least cost of runs (symbol, rows) and, of the cheapest edits, the ASCII-least letters."""
    after = [END]
    for symbol, n in reversed(runs):
        after.append(before(symbol, n, after[-1]))
    total, state, audit = after[-1][START], START, []
    for (symbol, n), end in zip(runs, reversed(after[:-1]), strict=True):
        own = edits(symbol)
        for first in range(0, n, BLOCK):
            rows = min(BLOCK, n - first)
            costs = [before(symbol, n - first - rows, end)]
            for _ in range(rows):
                costs.append(before(symbol, 1, costs[-1]))
            for i in range(rows, 0, -1):
                here, then = costs[i], costs[i - 1]
                while True:
                    letter, to = next(((x, t) for x, c, t in own[state] if c + then[t] == here[state] and x == "D"), (None, 0))
                    if letter is None and INSERTED + here[STEP[state]] == here[state]:
                        audit.append("I")
                        state = STEP[state]
                        continue
                    if letter is None:
                        letter, to = next((x, t) for x, c, t in own[state] if c + then[t] == here[state])
                    audit.append(letter)
                    state = to
                    break
    while END[state]:
        audit.append("I")
        state = STEP[state]
    return total, "".join(audit)


def damaged(rows: DataFrame) -> DataFrame:
    """Distinct rows after damage with their number n; by the CRC of `conv_id:turn` modulo 20."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(space("role"))
    left = rows.where(kind != 0).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("n"))
    return left.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


def _turn() -> Column:
    return F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))


def with_faults(rows: DataFrame) -> DataFrame:
    """rows with the fault of the first of each n: blank, duplicate, truncated or none. The others are duplicates unless blank."""
    first = rows.groupBy(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.sha2("text", 256).alias("_t")).agg(F.min(_turn()).alias("first"))
    joined = rows.withColumn("_h", F.sha2("text", 256)).join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("_h") == F.col("_t")))
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank").when(_turn() > F.col("first"), "duplicate").when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated").otherwise("none")
    return joined.select("conv_id", "turn", "role", "text", "n", fault.alias("fault"))


PIECE = "conv_id long, part int, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, head string, tail string, symbols string, lengths array<long>"
FIELDS = {"low": pa.int64(), "high": pa.int64(), "turns": pa.int64(), "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(), "illegal": pa.int64(), "head": pa.string(), "tail": pa.string(), "symbols": pa.string(), "lengths": pa.list_(pa.int64())}
LEGAL = {"su", "ua", "au"}


class Piece:
    """What neighbouring rows of a conversation add up to."""

    def __init__(self):
        self.low = self.high = self.head = self.tail = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.runs: list[list] = []

    def put(self, symbol: str, n: int) -> None:
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += n
        elif n:
            self.runs.append([symbol, n])

    def row(self, turn: int | None, initial: str, fault: str, n: int) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.illegal += (self.tail is not None and self.tail + initial not in LEGAL) + n - 1
        self.head, self.tail = initial if self.head is None else self.head, initial
        self.blank += n if fault == "blank" else 0
        self.duplicate += n if fault == "duplicate" else n - 1 if fault != "blank" else 0
        self.truncated += fault == "truncated"
        symbol = initial if initial in KEEP else "o"
        self.put(GONE if fault in ("blank", "duplicate") else symbol.upper() if fault == "truncated" else symbol, 1)
        self.put(GONE, n - 1)

    def add(self, p: dict) -> None:
        """A later piece of the same conversation."""
        self.turns += p["turns"] - (p["low"] is not None and p["low"] == self.high)
        self.low = p["low"] if self.low is None else self.low
        self.high = self.high if p["high"] is None else p["high"]
        self.illegal += p["illegal"] + (self.tail is not None and self.tail + p["head"] not in LEGAL)
        self.head, self.tail = p["head"] if self.head is None else self.head, p["tail"]
        self.blank, self.duplicate, self.truncated = self.blank + p["blank"], self.duplicate + p["duplicate"], self.truncated + p["truncated"]
        for symbol, n in zip(p["symbols"], p["lengths"], strict=True):
            self.put(symbol, n)

    def values(self) -> dict:
        return {c: getattr(self, c) for c in FIELDS if c not in ("symbols", "lengths")} | {"symbols": "".join(x for x, _ in self.runs), "lengths": [n for _, n in self.runs]}


def _pieces(batches):
    """A row for each conversation of a task, from its rows in order."""
    conv, part, own, out = None, 0, None, []

    def batch():
        made = pa.RecordBatch.from_arrays([pa.array([x["conv_id"] for x in out], pa.int64()), pa.array([part] * len(out), pa.int32()), *(pa.array([x[c] for x in out], kind) for c, kind in FIELDS.items())], ["conv_id", "part", *FIELDS])
        out.clear()
        return made

    for rows in batches:
        part = rows.column("part")[0].as_py() if rows.num_rows else part
        for c, turn, initial, fault, n in zip(*(rows.column(x).to_pylist() for x in ("conv_id", "turn", "initial", "fault", "n")), strict=True):
            if own is None or c != conv:
                if own is not None:
                    out.append({"conv_id": conv} | own.values())
                conv, own = c, Piece()
            own.row(turn, initial, fault, n)
        if len(out) >= 1000:
            yield batch()
    if own is not None:
        out.append({"conv_id": conv} | own.values())
        yield batch()


RESULT = {"conv_id": pa.int64(), "gaps": pa.int64(), "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(), "illegal": pa.int64(), "cost": pa.int64(), "audit": pa.string(), "repaired_sha256": pa.string()}


class Rewriter:
    """Applies an audit to rows as they come and hashes what is left."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.sha, self.some = audit, 0, START, hashlib.sha256(), False

    def line(self, role: str, text: str) -> None:
        self.sha.update((f"\n{role}:{text}" if self.some else f"{role}:{text}").encode())
        self.some = True

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = STEP[self.state]
            self.line(ROLES[self.state], "")
            self.at += 1

    def row(self, role: str, text: str, n: int) -> None:
        for _ in range(n):
            self.inserted()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "K":
                self.state = KEEP[role[:1]][self.state]
                self.line(role, text)
            elif letter == "R":
                self.state = STEP[self.state]
                self.line(ROLES[self.state], text)

    def digest(self) -> str:
        self.inserted()
        return self.sha.hexdigest()


def _repaired(batches) -> Iterator[pa.RecordBatch]:
    """A row for each conversation, from its mark (kind 0), its pieces (1) and its rows (2), in this order."""
    conv, total, cost, writer, out = None, None, 0, None, []

    def close():
        gaps = 0 if total.low is None else total.high - total.low + 1 - total.turns
        audit = writer.audit if writer else ""
        out.append((conv, gaps, total.blank, total.duplicate, total.truncated, total.illegal, cost, audit, writer.digest() if writer else hashlib.sha256().hexdigest()))

    def batch():
        made = pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(RESULT.values())], list(RESULT))
        out.clear()
        return made

    for rows in batches:
        for i in range(0, rows.num_rows, 500):
            for x in rows.slice(i, 500).to_pylist():
                if x["kind"] == 0:
                    if total is not None:
                        close()
                    conv, total, cost, writer = x["conv_id"], Piece(), 0, None
                elif x["kind"] == 1:
                    total.add(x["piece"])
                else:
                    if writer is None:
                        cost, audit = repair([(s, n) for s, n in total.runs])
                        writer = Rewriter(audit)
                    writer.row(x["role"], x["text"], x["n"])
        if len(out) >= 1000:
            yield batch()
    if total is not None:
        close()
        yield batch()


def repaired(conversations: DataFrame) -> DataFrame:
    """The report of `op11`'s contract, a row for each conversation of rows (conv_id, turn, role, text)."""
    spark = conversations.sparkSession
    n = shuffle_partitions(spark)
    rows = stored(with_faults(damaged(conversations)), "turns")
    order = ["conv_id", "turn", "role", "text"]
    sorted_rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    pieces = sorted_rows.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "n", F.spark_partition_id().alias("part")).mapInArrow(_pieces, PIECE)
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    none = lambda kind: F.lit(None).cast(kind)
    piece = pieces.select("conv_id", F.lit(1).alias("kind"), "part", F.struct(*FIELDS).alias("piece"))
    shape = piece.schema["piece"].dataType
    mark = ids.select("conv_id", F.lit(0).alias("kind"), none("int").alias("part"), none(shape).alias("piece"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), none("long").alias("n"))
    piece = piece.select("*", none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), none("long").alias("n"))
    row = rows.select("conv_id", F.lit(2).alias("kind"), none("int").alias("part"), none(shape).alias("piece"), "turn", "role", "text", "n")
    together = mark.unionByName(piece).unionByName(row).repartition(n, "conv_id").sortWithinPartitions("conv_id", "kind", "part", "turn", "role", "text")
    return together.mapInArrow(_repaired, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(table(spark, sf_dir, "conversations"))
