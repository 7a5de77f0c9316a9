"""Conversation structure repair: a run-length dynamic programme over roles and faults.

A conversation is well formed if its role initials are `(s?(ua)+)?`. Edits are
Keep (0), Rerole to user or assistant (3), Delete (4, the only edit for a blank
or duplicate row) and Insert of an empty user or assistant turn (3); a truncated
row that is not deleted costs 3 more. The pattern is an automaton of four
states, so one row is a 4 x 4 min-plus matrix (inserts before it included).

Equal consecutive symbols (role initial and fault) are collapsed to runs, and a
run of n rows moves the vector of costs-to-go by the cached binary powers of its
matrix. From the start the audit is unrolled: in every state each edit leads to
one next state, so the cheapest audit that is ASCII-least takes the least
letter that still reaches the cost-to-go.

On Spark: equal rows of a conversation (same turn, role and text) are counted
before any row is shuffled (a digest stands for the text), so a hot turn is one
row with a number; whether role and text were seen earlier is a grouping by
their digest; the rows are ordered by ranges of (conversation, turn, role,
digest), so a conversation of any length is cut between tasks; each piece
becomes one byte a row. What meets in one group is a conversation's symbols,
as many bytes as its audit has letters. The texts cross the network
once, to be hashed in order; that stream holds one row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions_for, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: The characters that a text needs one of, not to be blank, are all but these.
SPACES = " \t\n\x0b\f\r"
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The turn that must come in a state (the system turn may come in START, too), and where it leads.
_DUE = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
_AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_NAMES = {"u": "user", "a": "assistant"}
#: Initials of a symbol, then its fault; a symbol is one byte, 4 * fault + initial.
INITIALS = "sua"
FINE, CUT, BLANK, DUPLICATE = range(4)
_INF = 1 << 60
#: Runs are unrolled with stored cost vectors this long at most, longer ones by halves.
UNROLLED = 4096
#: Rows of one ordered piece.
ROWS_PER_PIECE = 200_000


def _takes(state: int, initial: str) -> int | None:
    """State after a row with this initial, None where the pattern has no such row."""
    if initial == "s":
        return SYSTEM if state == START else None
    return _AFTER[initial] if initial and _DUE[state] == initial else None


def _min_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), _INF)


def _apply(m: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.minimum((m + v[None, :]).min(1), _INF)


def _inserts() -> np.ndarray:
    """Cheapest way from state to state by inserting turns only."""
    m = np.full((4, 4), _INF, np.int64)
    for start in range(4):
        cost, state = 0, start
        while m[start, state] > cost:
            m[start, state] = cost
            cost, state = cost + INSERT, _AFTER[_DUE[state]]
    return m


_CLOSURE = _inserts()
#: What it costs to end from each state.
FINAL = np.minimum(_CLOSURE[:, START], _CLOSURE[:, ASSISTANT])


def edits(symbol: int) -> list[list[tuple[str, int, int]]]:
    """For each state the edits of a row with this symbol: letter, cost, next state."""
    initial, fault = (INITIALS + " ")[symbol % 4].strip(), symbol // 4
    out = []
    for state in range(4):
        here = [("D", DELETE, state)]
        if fault in (FINE, CUT):
            more = TRUNCATED * (fault == CUT)
            if (after := _takes(state, initial)) is not None:
                here.append(("K", KEEP + more, after))
            here.append(("R", REROLE + more, _AFTER[_DUE[state]]))
        out.append(here)
    return out


@lru_cache(maxsize=None)
def power(symbol: int, k: int) -> np.ndarray:
    """Min-plus matrix of 2**k rows with this symbol."""
    if k:
        return _min_plus(power(symbol, k - 1), power(symbol, k - 1))
    m = np.full((4, 4), _INF, np.int64)
    for state, here in enumerate(edits(symbol)):
        for _, cost, after in here:
            m[state, after] = min(m[state, after], cost)
    return _min_plus(_CLOSURE, m)


@lru_cache(maxsize=None)
def _choices(symbol: int) -> list[list[tuple[str, int, int]]]:
    """All edits in a state with rows left, least letter first; an insert stays at the row."""
    return [sorted([*here, ("I", INSERT, _AFTER[_DUE[state]])]) for state, here in enumerate(edits(symbol))]


def runs_of(symbols: np.ndarray) -> list[tuple[int, int]]:
    if not len(symbols):
        return []
    at = np.flatnonzero(np.diff(symbols, prepend=symbols[0] + 1))
    return [(int(symbols[i]), int(n)) for i, n in zip(at, np.diff(at, append=len(symbols)), strict=True)]


def before_run(symbol: int, n: int, after: np.ndarray) -> np.ndarray:
    """Costs-to-go before n rows with this symbol, from those behind them."""
    k = 0
    while n >> k:
        if n >> k & 1:
            after = _apply(power(symbol, k), after)
        k += 1
    return after


def _unroll(symbol: int, n: int, state: int, after: np.ndarray, out: list[str]) -> int:
    """Append the letters for n equal rows; the state behind them."""
    if n > UNROLLED:
        half = n // 2
        middle = before_run(symbol, n - half, after)
        return _unroll(symbol, n - half, _unroll(symbol, half, state, middle, out), after, out)
    vectors = [after.tolist()]
    for _ in range(n):
        vectors.append(_apply(power(symbol, 0), np.array(vectors[-1])).tolist())
    choices, i = _choices(symbol), n
    while i:
        to_go = vectors[i][state]
        for letter, cost, following in choices[state]:
            left = i - (letter != "I")
            if cost + vectors[left][following] == to_go:
                out.append(letter)
                i, state = left, following
                break
    return state


def repair(symbols: np.ndarray) -> tuple[int, str]:
    """Least cost and the ASCII-least audit of that cost."""
    runs = runs_of(symbols)
    behind = [FINAL]
    for symbol, n in reversed(runs):
        behind.append(before_run(symbol, n, behind[-1]))
    behind.reverse()
    out: list[str] = []
    state = START
    for (symbol, n), after in zip(runs, behind[1:], strict=True):
        state = _unroll(symbol, n, state, after, out)
    while FINAL[state]:
        out.append("I")
        state = _AFTER[_DUE[state]]
    return int(behind[0][START]), "".join(out)


# ---------------------------------------------------------------- rows of a conversation


def _or_space(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """_conv, _turn, _role, _text, _n (0: dropped, 2: repeated) of every row, nulls read as one space.

    The damage is drawn from crc32 of `conv_id:turn`, remainder by 20: 0 drops
    the row, 1 empties the text, 2 removes `.`, `!` and `?`, 3 repeats the row,
    4 makes it a user's."""
    draw = F.crc32(F.concat(_or_space(F.col("conv_id")), F.lit(":"), _or_space(F.col("turn"))).cast("binary")) % 20
    text = _or_space(F.col("text"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("_conv"), F.col("turn").cast("long").alias("_turn"),
        F.when(draw == 4, "user").otherwise(_or_space(F.col("role"))).alias("_role"),
        F.when(draw == 1, "").when(draw == 2, F.translate(text, ".!?", "")).otherwise(text).alias("_text"),
        F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1).cast("long").alias("_n"))


def as_rows(conversations: DataFrame) -> DataFrame:
    """The same columns for conversations that are repaired as they are."""
    return conversations.select(F.col("conv_id").cast("long").alias("_conv"), F.col("turn").cast("long").alias("_turn"),
                                _or_space(F.col("role")).alias("_role"), _or_space(F.col("text")).alias("_text"),
                                F.lit(1).cast("long").alias("_n"))


_ORDER = ["_conv", "_turn", "_role", "_digest"]
_PIECES = "_conv long, _piece int, _symbols binary, _turns long, _first long, _last long"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of this task, in order, as the symbols of each of its conversations."""
    from pyspark import TaskContext

    piece = TaskContext.get().partitionId()
    conv, started = None, False
    symbols, turns, first, last = bytearray(), 0, None, None

    def done() -> tuple:
        return conv, piece, bytes(symbols), turns, first, last

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                          names=["_conv", "_piece", "_symbols", "_turns", "_first", "_last"])

    for batch in batches:
        out = []
        for c, turn, symbol, n in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            if not started or c != conv:
                if started:
                    out.append(done())
                conv, started = c, True
                symbols, turns, first, last = bytearray(), 0, None, None
            if not n:
                continue
            symbols.append(symbol)
            again = symbol if symbol // 4 == BLANK else 4 * DUPLICATE + symbol % 4
            symbols.extend(bytes([again]) * (n - 1))
            if turn is not None and turn != last:
                turns, first, last = turns + 1, turn if first is None else first, turn
        if out:
            yield batch_of(out)
    if started:
        yield batch_of([done()])


#: Pieces and results of conversations.
_STATS = "_conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_LEGAL = {(0, 1), (1, 2), (2, 1)}


@lru_cache(maxsize=100_000)
def _known_repair(symbols: bytes) -> tuple[int, str]:
    return repair(np.frombuffer(symbols, np.uint8))


def _solve(pieces: list[tuple]) -> tuple:
    """One conversation: its pieces in order, joined, counted and repaired."""
    raw = b"".join(p[0] for p in pieces)
    symbols = np.frombuffer(raw, np.uint8)
    gaps = turns = 0
    low = last = None
    for _, n, first, end in pieces:
        if n:
            turns += n - (last == first)  # a turn cut between two pieces
            low, last = (first if low is None else low), end
            gaps = last - low + 1 - turns
    faults = np.bincount(symbols // 4, minlength=4)
    initials = (symbols % 4).astype(np.int64)
    pairs = np.bincount(initials[:-1] * 4 + initials[1:], minlength=16)
    illegal = int(pairs.sum() - sum(pairs[4 * a + b] for a, b in _LEGAL))
    cost, audit = _known_repair(raw) if len(raw) <= 64 else repair(symbols)
    return gaps, int(faults[BLANK]), int(faults[DUPLICATE]), int(faults[CUT]), illegal, cost, audit


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of this task's conversations, in order; one row for each conversation."""
    names = [f.split()[0] for f in _STATS.split(", ")]
    types = [pa.int64()] * 7 + [pa.string()]
    conv, held = None, []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for batch in batches:
        out = []
        for c, *piece in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
            if held and c != conv:
                out.append((conv, *_solve(held)))
                held = []
            conv = c
            held.append(tuple(piece))
        if out:
            yield batch_of(out)
    if held:
        yield batch_of([(conv, *_solve(held))])


_RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


class _Writer:
    """Writes the repaired rows of one conversation into a hash, following its audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.sha, self.any = audit, 0, START, hashlib.sha256(), False

    def _put(self, role: str, text: str, state: int) -> None:
        self.sha.update((b"\n" if self.any else b"") + role.encode() + b":" + text.encode())
        self.any, self.state = True, state

    def inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            due = _DUE[self.state]
            self._put(_NAMES[due], "", _AFTER[due])
            self.at += 1

    def row(self, role: str, text: str, n: int) -> None:
        for _ in range(n):
            self.inserts()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "K":
                self._put(role, text, _AFTER[role[0]])
            elif letter == "R":
                due = _DUE[self.state]
                self._put(_NAMES[due], text, _AFTER[due])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's counts and audit, followed by its rows in order; one result row each."""
    stats, writer = None, None
    names = [f.split()[0] for f in _RESULT.split(", ")]
    types = [pa.int64()] * 7 + [pa.string()] * 2

    def finished() -> tuple:
        writer.inserts()
        return (*stats, writer.sha.hexdigest())

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for batch in batches:
        out = []
        for kind, role, text, n, *head in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if kind == 0:
                if stats is not None:
                    out.append(finished())
                stats, writer = head, _Writer(head[-1])
            else:
                writer.row(role, text, n)
        if out:
            yield batch_of(out)
    if stats is not None:
        yield batch_of([finished()])


def repair_rows(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of the rows of `damaged` or `as_rows`."""
    spark = rows.sparkSession
    digest = F.unhex(F.sha2("_text", 256))
    body = F.rtrim(F.col("_text"), F.lit(SPACES))
    initial = F.coalesce(F.array_position(F.array(*map(F.lit, INITIALS)), F.substring("_role", 1, 1)), F.lit(0))
    initial = F.when(initial == 0, 3).otherwise(initial - 1)
    fault = F.when(body == "", BLANK).when(F.substring(body, -1, 1).isin(".", "!", "?"), FINE).otherwise(CUT)
    light = rows.select("_conv", "_turn", "_role", F.when(F.col("_n") > 0, digest).alias("_digest"), "_n",
                        (4 * fault + initial).cast("int").alias("_symbol"))
    light = written(light.groupBy(*_ORDER, "_symbol").agg(F.sum("_n").alias("_n")), "op13-rows")
    same = ["_conv", "_role", "_digest"]
    # a null turn comes first: it is below every number here, and no number equals it
    turn = F.struct(F.col("_turn").isNotNull().alias("has"), F.col("_turn").alias("turn"))
    seen = light.where("_n > 0").groupBy(*same).agg(F.min(turn).alias("_since"), F.count(F.lit(1)).alias("_turns")).where("_turns > 1")
    seen = seen.select(*[F.col(c).alias(c + "_s") for c in same], "_since")
    joined = light.join(seen, [F.col(c).eqNullSafe(F.col(c + "_s")) for c in same], "left")
    later = F.col("_since").isNotNull() & (F.col("_since") < turn) & (F.col("_n") > 0)
    marked = joined.select(*_ORDER, "_n", F.when(later & (F.floor(F.col("_symbol") / 4) != BLANK), 4 * DUPLICATE + F.col("_symbol") % 4)
                           .otherwise(F.col("_symbol")).cast("int").alias("_symbol"))
    marked = written(marked, "op13-marked")
    tasks = partitions_for(spark, marked.count(), ROWS_PER_PIECE)
    ordered = marked.repartitionByRange(tasks, *[F.col(c).asc_nulls_first() for c in _ORDER])
    ordered = ordered.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in _ORDER])
    found = written(ordered.select("_conv", "_turn", "_symbol", "_n").mapInArrow(_pieces, _PIECES), "op13-pieces")
    stats = found.repartition(tasks, "_conv").sortWithinPartitions(F.col("_conv").asc_nulls_first(), "_piece")
    stats = stats.select("_conv", "_symbols", "_turns", "_first", "_last").mapInArrow(_solved, _STATS)
    head = [f.split()[0] for f in _STATS.split(", ")]
    nothing = [F.lit(None).cast("string" if c == "audit" else "long").alias("_" + c.lstrip("_") + "_h") for c in head]
    heads = stats.select("_conv", F.lit(0).alias("_kind"), F.lit(None).cast("long").alias("_turn"), F.lit(None).cast("string").alias("_role"),
                         F.lit(None).cast("binary").alias("_digest"), F.lit(None).cast("string").alias("_text"), F.lit(0).cast("long").alias("_n"),
                         *[F.col(c).alias("_" + c.lstrip("_") + "_h") for c in head])
    texts = (rows.where("_n > 0").groupBy("_conv", "_turn", "_role", "_text").agg(F.sum("_n").alias("_n"))
             .select("_conv", F.lit(1).alias("_kind"), "_turn", "_role", digest.alias("_digest"), "_text", "_n", *nothing))
    order = ["_conv", "_kind", "_turn", "_role", "_digest"]
    stream = heads.unionByName(texts).repartition(tasks, "_conv")
    stream = stream.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    return (stream.select("_kind", "_role", "_text", "_n", *["_" + c.lstrip("_") + "_h" for c in head])
            .mapInArrow(_hashed, _RESULT))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Damage, then repair: one row for every conv_id of the input.

    Rows are taken by turn, null turns first; equal turns in the order of role
    and SHA-256 of the text, so the result does not depend on the rows' place.
    A repeated row follows its original. A null conv_id is a conversation of its
    own. Null role, text or turn count as one space in the damage's draw and in
    the row: such a text is blank, such a role is of no kind (deleted or
    reroled). Role initials are first characters as they are. Empty texts are
    blank; texts of any length are hashed whole. gaps is 0 if all turns are
    null. A conversation whose rows are all dropped has zeros, an empty audit
    and the hash of the empty string. Repeated rows of the input are later
    copies: duplicates. Other columns are not read; an empty table gives no row.
    """
    return repair_rows(damaged(conversations))
