"""Conversation structure repair: cheapest edits to a well-formed exchange, by lazy weighted determinisation.

A conversation is to have the role initials ``(s?(ua)+)?``. That grammar has four states; reading one row after its edits
turns the vector of what the rest costs from each state into that of one row earlier. Vectors less their minimum are the
states of a deterministic automaton: they are numbered as they occur, and a table holds, for a state and a symbol (role
and fault of a row), the next state and the cost taken out. The scan of a conversation is a table lookup a row and gives
its cost. It begins at the last row, so that the trace back through it along tight arcs (those that are part of a cheapest
repair) goes from the first row on and can take the least letter each time: that is the audit.

What is held for a conversation is a few bytes a row, as its audit is. Texts stream by once more in the order of the rows to be
repaired, so a conversation of any length needs bounded memory; repeats are found by grouped minima before.

Defined results: a null role or text counts as one space, a null turn comes first, rows with a null conv_id are one
conversation; rows of one turn are taken by role, then by the digest of role and text, so equal rows lie side by side; roles with other initials, empty
ones included, have to be renamed or deleted; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ASCII_SPACE, prepare, saved

#: Costs of the edits; a row that stays truncated costs more.
KEEP, RENAME, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the grammar: nothing yet, after s, after u, after a. What an output of each role leads to.
START, FINAL, STATES = 0, (0, 3), 4
GOTO = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ROLES = {"u": "user", "a": "assistant"}
#: Symbols: 0 has to be deleted; then two for each initial, whole and truncated.
INITIALS = "sua-"
SYMBOLS = 1 + 2 * len(INITIALS)
LEGAL = {"su", "ua", "au"}
FAR = 1 << 30


def edits(symbol: int) -> list[tuple[str, int, str | None]]:
    """(letter, cost, initial that it puts out) of what may be done with a row."""
    found: list[tuple[str, int, str | None]] = [("D", DELETE, None)]
    if symbol:
        initial, more = INITIALS[(symbol - 1) // 2], TRUNCATED * ((symbol - 1) % 2)
        if initial in GOTO:
            found.append(("K", KEEP + more, initial))
        found += [("R", RENAME + more, x) for x in ROLES]
    return found


class Automaton:
    """The deterministic automaton, as far as it has been needed; kept by a worker for all its conversations."""

    def __init__(self) -> None:
        self.vectors: list[tuple[int, ...]] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.next: list[int] = []
        self.cost: list[int] = []
        self.steps: dict[tuple[int, int, int, frozenset[int]], tuple[bytes, frozenset[int]]] = {}
        self.end, _ = self._state([0 if q in FINAL else FAR for q in range(STATES)])

    def _state(self, costs: list[int]) -> tuple[int, int]:
        """Number of the state of a vector, closed under insertions and normalised; what was taken out."""
        for _ in range(STATES):
            for q in range(STATES):
                costs[q] = min(costs[q], *(INSERT + costs[GOTO[x][q]] for x in ROLES if q in GOTO[x]), FAR)
        low = min(costs)
        vector = tuple(c - low for c in costs)
        if vector not in self.numbers:
            self.numbers[vector] = len(self.vectors)
            self.vectors.append(vector)
            self.next += [-1] * SYMBOLS
            self.cost += [0] * SYMBOLS
        return self.numbers[vector], low

    def _fill(self, state: int, symbol: int) -> None:
        after = self.vectors[state]
        costs = [min(cost + (after[q] if out is None else after[GOTO[out][q]] if q in GOTO[out] else FAR) for _, cost, out in edits(symbol)) for q in range(STATES)]
        self.next[state * SYMBOLS + symbol], self.cost[state * SYMBOLS + symbol] = self._state(costs)

    def scan(self, symbols: bytes) -> tuple[int, list[int]]:
        """Cost of the cheapest repair, and the state before each row and at the end."""
        state, total, states = self.end, 0, [self.end]
        for symbol in reversed(symbols):
            at = state * SYMBOLS + symbol
            if self.next[at] < 0:
                self._fill(state, symbol)
            total += self.cost[at]
            state = self.next[at]
            states.append(state)
        return total + self.vectors[state][START], states[::-1]

    def _inserted(self, vector: tuple[int, ...], front: frozenset[int]) -> frozenset[int]:
        return frozenset(GOTO[x][q] for x in ROLES for q in front if q in GOTO[x] and vector[q] == INSERT + vector[GOTO[x][q]])

    def _step(self, now: int, symbol: int, then: int, front: frozenset[int]) -> tuple[bytes, frozenset[int]]:
        """Letters up to and with the row's own, the least along tight arcs, and the grammar states that they lead to."""
        vector, after, taken, letters = self.vectors[now], self.vectors[then], self.cost[then * SYMBOLS + symbol], b""
        while True:
            options: dict[str, set[int]] = {}
            for letter, cost, out in edits(symbol):
                for q in front:
                    to = q if out is None else GOTO[out].get(q)
                    if to is not None and vector[q] + taken == cost + after[to]:
                        options.setdefault(letter, set()).add(to)
            if more := self._inserted(vector, front):
                options["I"] = set(more)
            least = min(options)
            letters += least.encode()
            front = frozenset(options[least])
            if least != "I":
                return letters, front

    def trace(self, symbols: bytes, states: list[int]) -> bytes:
        """The ASCII-least letters of a cheapest repair."""
        front, audit = frozenset([START]), bytearray()
        for k, symbol in enumerate(symbols):
            key = (states[k], symbol, states[k + 1], front)
            if key not in self.steps:
                self.steps[key] = self._step(*key)
            letters, front = self.steps[key]
            audit += letters
        vector = self.vectors[states[-1]]
        while not any(q in FINAL and vector[q] == 0 for q in front):
            front = self._inserted(vector, front)
            audit += b"I"
        return bytes(audit)


def _key(conv: Column) -> Column:
    """A string that tells conversations apart, null ones included."""
    return F.when(conv.isNull(), F.lit(" ")).otherwise(F.concat(F.lit("="), conv.cast("string")))


def _rows(conversations: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    mark = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    return conversations.select(_key(F.col("conv_id")).alias("conv"), "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), mark.alias("mark"))


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark")]


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(conversations: DataFrame) -> DataFrame:
    """One row a conversation: conv (a key), conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    prepare(conversations.sparkSession)
    rows = _rows(conversations)
    tail = F.rtrim("text", F.lit(ASCII_SPACE))
    flags = rows.select("conv", "conv_id", "turn", "role", "mark", (tail == "").alias("blank"), (~F.substring(tail, -1, 1).isin(".", "!", "?")).alias("cut"))
    runs = flags.groupBy("conv", "turn", "role", "mark").agg(F.first("conv_id").alias("conv_id"), F.first("blank").alias("blank"), F.first("cut").alias("cut"), F.count("*").alias("n"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = flags.groupBy("conv", "mark").agg(F.min(place).alias("low"))
    found = runs.join(first, ["conv", "mark"]).select("conv", "conv_id", "turn", "role", "mark", F.substring("role", 1, 1).alias("initial"), "blank", "cut", place.eqNullSafe(F.col("low")).alias("fresh"), "n")
    dealt = found.repartition("conv").sortWithinPartitions("conv", *_order()).select("conv", "conv_id", "turn", "initial", "blank", "cut", "fresh", "n")
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, held = Automaton(), None
        for batch in batches:
            done = []
            for conv, conv_id, turn, initial, blank, cut, fresh, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or held.conv != conv:
                    done += [held] if held else []
                    held = _Conversation(conv, conv_id)
                held.add(turn, initial, blank, cut, fresh, n)
            if done:
                yield _summaries(done, automaton, batch.schema.field("conv_id").type)
        if held:
            yield _summaries([held], automaton, batch.schema.field("conv_id").type)

    return dealt.mapInArrow(run, f"conv string, conv_id {kind}, {SUMMARY}")


class _Conversation:
    """What a conversation's rows add up to; a symbol for each row."""

    def __init__(self, conv: str, conv_id: object) -> None:
        self.conv, self.conv_id, self.symbols = conv, conv_id, bytearray()
        self.low = self.high = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, initial: str, blank: bool, cut: bool, fresh: bool, n: int) -> None:
        """``n`` equal rows of one turn; ``fresh``: no earlier turn has such a row."""
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        if self.before is not None:
            self.illegal += self.before + initial not in LEGAL
        self.illegal += n - 1
        self.before = initial
        if blank:
            self.blank += n
            self.symbols += bytes(n)
            return
        self.duplicate += n - fresh
        if fresh:
            self.truncated += cut
            self.symbols.append(1 + 2 * (INITIALS.index(initial) if initial in GOTO else 3) + cut)
        self.symbols += bytes(n - fresh)

    def summary(self, automaton: Automaton) -> tuple:
        cost, states = automaton.scan(self.symbols)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv, self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, automaton.trace(self.symbols, states).decode()


def _summaries(done: list[_Conversation], automaton: Automaton, kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*(c.summary(automaton) for c in done), strict=True))
    types = [pa.string(), kind, *[pa.int64()] * 6, pa.string()]
    names = ["conv", "conv_id", *(x.split()[0] for x in SUMMARY.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def repaired(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired rows (conv, place, role, text) by the ``audits`` found. Those of a conversation lie in one partition, in order."""
    audit = found.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("mark"), F.col("audit").alias("text"))
    rows = _rows(conversations).select("conv", F.lit(1).alias("kind"), "turn", "role", "mark", "text")
    dealt = audit.unionByName(rows).repartition("conv").sortWithinPartitions("conv", "kind", *_order()).select("conv", "kind", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, place, odd, conv = "", 0, 0, 0, ""
        for batch in batches:
            out: list[tuple[str, int, str, str]] = []

            def put(role: str | None, text: str, out: list = out) -> None:
                nonlocal at, place
                out.append((conv, place, role or ("assistant" if (place - odd) % 2 else "user"), text))
                at, place = at + 1, place + 1

            for own, kind, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not kind:
                    while audit[at : at + 1] == "I":
                        put(None, "")
                    conv, audit, at, place = own, text, 0, 0
                    odd = (len(audit) - audit.count("D")) % 2  # a system row first
                    continue
                while audit[at] == "I":
                    put(None, "")
                if audit[at] == "D":
                    at += 1
                else:
                    put(role if audit[at] == "K" else None, text)
            if out:
                yield _lines(out)
        out = []
        while audit[at : at + 1] == "I":
            out.append((conv, place, "assistant" if (place - odd) % 2 else "user", ""))
            at, place = at + 1, place + 1
        if out:
            yield _lines(out)

    return dealt.mapInArrow(run, "conv string, place long, role string, text string")


def _lines(out: list[tuple[str, int, str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["conv", "place", "role", "text"])


def digests(lines: DataFrame) -> DataFrame:
    """conv and the SHA-256 (hex) of its rows ``role:text``, joined by newlines, of ``repaired`` rows as they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for own, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text")), strict=True):
                if own != conv:
                    done += [(conv, state.hexdigest())] if conv is not None else []
                    conv, state = own, hashlib.sha256()
                    state.update(f"{role}:{text}".encode())
                else:
                    state.update(f"\n{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_pylist([{"conv": c, "sha256": s} for c, s in done])
        if conv is not None:
            yield pa.RecordBatch.from_pylist([{"conv": conv, "sha256": state.hexdigest()}])

    return lines.mapInArrow(run, "conv string, sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as a lossy export leaves them, decided by the CRC-32 of ``conv_id:turn``: some dropped, emptied, without ends of sentences, doubled or renamed to user."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    rows = conversations.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), fate.alias("fate")).where("fate <> 0")
    text = F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("fate") == 3, F.lit(2)).otherwise(F.lit(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), copies)).alias("copy")).drop("copy")


def report(conversations: DataFrame, broken: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: its audit among the rows ``broken``, and the digest of the repaired rows."""
    found = saved(audits(broken), "audits")
    hashes = digests(repaired(broken, found))
    ids = conversations.select(_key(F.col("conv_id")).alias("conv"), "conv_id").groupBy("conv").agg(F.first("conv_id").alias("conv_id"))
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256().hexdigest())
    return ids.join(found.drop("conv_id"), "conv", "left").join(hashes, "conv", "left").select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", empty).alias("repaired_sha256"))
