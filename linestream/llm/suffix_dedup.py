"""Suffix-array dedup: remove every byte of a long enough repeated string.

A string of `LENGTH` bytes that starts twice anywhere in the table holds, at
the same place in both, the k-mer of `CORE` bytes with the smallest hash among
its `WINDOW` k-mers. So every such k-mer of each text is taken with the bytes
that may belong to a string around it (its window), windows with the same core
meet, and a suffix array over the different windows of a core (linear
grouping, see suffix_sort) shows which strings have an equal neighbour:

1. Documents are packed into units, with the places of their cores.
2. Each unit deals out its different windows as hashes of core and context.
3. A core met in one context only needs no sorting: repeated windows repeat
   whole. Of a core with several contexts each different window is sent once.
4. The windows of a core are sorted; what the neighbours share marks starts.
5. Units mark the bytes of all repeated strings and cut them out.

What a unit holds twice it deals once, so a passage that a third of all
documents share reaches its part once per unit. A core with very many
different windows is not sorted in one place: its strings of `LENGTH` bytes
are dealt by their own hash, each apart, which is exact as well. Cores that
are frequent all over (at most 2**20) are known to the tasks beforehand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .katz import dealt, pack, pack_keys, unpack, unpack_keys
from .suffix_sort import suffix_array

LENGTH = 200
CORE = 150
#: k-mers of one string; also one more than the context bytes on either side.
WINDOW = LENGTH - CORE + 1
CONTEXT = WINDOW - 1
#: Bytes of text in a unit (a longer document is a unit of its own).
UNIT_BYTES = 4_000_000
#: Different windows of a core that are sorted in one place.
GROUP_LIMIT = 2_000
#: Cores a task is told of beforehand: met in at least total / FREQUENT windows.
FREQUENT = 1 << 20
#: Windows of a core within one unit that make it a candidate for that.
LOCALLY_MANY = 32
PARTS_EACH = 3
_CHUNK = 1 << 20

_ROWS = "part int, kind int, unit long, packed binary"
#: Kinds of rows: windows and strings asked for, codes, window bytes, starts found.
WINDOWS, STRINGS, SENT, LATE_STRINGS, MASKS, CODES = range(6)
#: Codes for a unit's window: every string repeats; send the bytes; deal the strings apart.
ALL, SEND, APART = 1, 2, 4

# ---------------------------------------------------------------- hashing

_ODD = 0x9E3779B97F4A7C15
_M = 1 << 64


@lru_cache(maxsize=2)
def _powers(inverse: bool) -> np.ndarray:
    base = np.full(_CHUNK + LENGTH + 1, pow(_ODD, -1, _M) if inverse else _ODD, np.uint64)
    base[0] = 1
    return np.cumprod(base, dtype=np.uint64)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    return _mix(x ^ x >> np.uint64(31))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def _sums(text: np.ndarray) -> np.ndarray:
    out = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_byte_values()[text] * _powers(False)[:len(text)], out=out[1:])
    return out


def hashes(text: np.ndarray, start: np.ndarray, *spans: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Polynomial hash of text[a:b] for each (a, b) of `spans`; all within
    LENGTH bytes of the sorted `start`."""
    out = [np.zeros(len(start), np.uint64) for _ in spans]
    for at in range(0, len(text), _CHUNK):
        lo, hi = np.searchsorted(start, [at, at + _CHUNK])
        if lo == hi:
            continue
        first = max(0, at - LENGTH)
        for piece, shift in _pieces(text, first, at + _CHUNK + 2 * LENGTH):
            sums, inverse = _sums(piece), _powers(True)
            for o, (a, b) in zip(out, spans, strict=True):
                own = np.flatnonzero((a[lo:hi] >= shift) & (b[lo:hi] <= shift + len(piece))) + lo
                i, j = a[own] - shift, b[own] - shift
                o[own] = _mix((sums[j] - sums[i]) * inverse[i] + (j - i).astype(np.uint64))
    return out


def _pieces(text: np.ndarray, first: int, last: int) -> Iterator[tuple[np.ndarray, int]]:
    step = _CHUNK - 4 * LENGTH
    for at in range(first, min(last, len(text)), step):
        yield text[at:min(last, at + _CHUNK)], at


def core_places(text: np.ndarray) -> np.ndarray:
    """Places of the cores: for each string of LENGTH bytes the leftmost of its
    k-mers with the smallest hash."""
    n = len(text) - LENGTH + 1
    found = []
    step = _CHUNK - LENGTH
    for at in range(0, max(n, 0), step):
        piece = text[at:at + step + LENGTH - 1]
        sums = _sums(piece)
        h = _mix((sums[CORE:] - sums[:-CORE]) * _powers(True)[:len(piece) - CORE + 1])
        m = len(h)
        value = h & np.uint64(0xFFFFFFFF00000000) | np.arange(m, dtype=np.uint64)
        blocks = np.full(-(-m // WINDOW) * WINDOW, np.uint64(_M - 1))
        blocks[:m] = value
        grid = blocks.reshape(-1, WINDOW)
        left = np.minimum.accumulate(grid, axis=1).ravel()
        right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(right[:m - WINDOW + 1], left[WINDOW - 1:m]) & np.uint64(0xFFFFFFFF)
        place = least[np.concatenate([[True], least[1:] != least[:-1]])].astype(np.int64) + at
        found.append(place)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


# ---------------------------------------------------------------- units


@dataclass
class Unit:
    """Some documents, end to end, and the places of their cores."""

    number: int
    keys: np.ndarray
    missing: np.ndarray
    ends: np.ndarray  # of the documents in `text`
    text: np.ndarray
    places: np.ndarray

    def windows(self):
        """Core hash, context hash, and the window's limits in the text, by place."""
        doc = np.searchsorted(self.ends, self.places, side="right")
        begin, end = (self.ends[doc] - self.sizes[doc], self.ends[doc]) if len(doc) else (doc, doc)
        low = np.maximum(begin, self.places - CONTEXT)
        high = np.minimum(end, self.places + CORE + CONTEXT)
        p = self.places
        core, left, right = hashes(self.text, p, (p, p + CORE), (low, p), (p + CORE, high))
        return core, _mix(left + right * np.uint64(_ODD)), low, high

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, units = TaskContext.get().partitionId(), 0
    held: list[tuple[int | None, bytes]] = []
    size = 0

    def close() -> pa.RecordBatch:
        nonlocal units, held, size
        ends = np.cumsum([len(t) for _, t in held])
        text = b"".join(t for _, t in held)
        places = [core_places(np.frombuffer(t, np.uint8)) + e - len(t) for (_, t), e in zip(held, ends, strict=True)]
        places = np.concatenate(places).astype(np.uint64)
        docs = pack(np.array([k or 0 for k, _ in held], np.int64), np.array([k is None for k, _ in held], np.uint8),
                    ends.astype(np.int64))
        row = pa.RecordBatch.from_arrays(
            [pa.array([task << 32 | units], pa.int64()), pa.array([docs], pa.binary()),
             pa.array([zstandard.ZstdCompressor(level=3).compress(text)], pa.binary()),
             pa.array([pack_keys(places)], pa.binary()), pa.array([len(places)], pa.int64())],
            names=["unit", "docs", "text", "places", "n_places"])
        units, held, size = units + 1, [], 0
        return row

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = text or b""
            if held and size + len(text) > UNIT_BYTES:
                yield close()
            held.append((key, text))
            size += len(text)
    if held:
        yield close()


def _unit(number: int, docs: bytes, text: bytes, places: bytes) -> Unit:
    keys, missing, ends = unpack(docs, "i8", "u1", "i8")
    return Unit(number, keys, missing, ends, np.frombuffer(zstandard.ZstdDecompressor().decompress(text), np.uint8)
                if ends[-1] else np.zeros(0, np.uint8), unpack_keys(places)[0].astype(np.int64))


def _units_in(batch: pa.RecordBatch | pa.Table) -> Iterator[Unit]:
    for row in batch.select(["unit", "docs", "text", "places"]).to_pylist():
        yield _unit(*row.values())


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    part, kind, unit, packed = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(unit, pa.int64()),
                                       pa.array(packed, pa.binary())], names=["part", "kind", "unit", "packed"])


@dataclass
class _Different:
    """A unit's different (a, b) keys in ascending order."""

    a: np.ndarray
    b: np.ndarray
    often: np.ndarray  # met more than once in the unit
    first: np.ndarray  # an instance of each
    number: np.ndarray  # of each instance


def _different(a: np.ndarray, b: np.ndarray) -> _Different:
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]) if len(a) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    number = np.empty(len(a), np.int64)
    number[order] = np.cumsum(new) - 1
    return _Different(x[new], y[new], np.diff(np.append(starts, len(a))) > 1, order[new], number)


def _is_in(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_) or not len(values):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


def _string_starts(unit: Unit, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Starts of the strings that hold the cores of the windows `at`."""
    first, last = low[at], np.minimum(unit.places[at], high[at] - LENGTH)
    n = np.maximum(last - first + 1, 0)
    return np.unique(np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum())))


def _strings(unit: Unit, starts: np.ndarray) -> _Different:
    """Two hashes of each string, of its halves and of the whole."""
    whole, half = hashes(unit.text, starts, (starts, starts + LENGTH), (starts, starts + LENGTH // 2))
    return _different(whole, half)


def _deal_keys(d: _Different, kind: int, unit: int, parts: int) -> list[tuple]:
    numbers = np.arange(len(d.a), dtype=np.uint32)
    return [(p, kind, unit, pack_keys(d.a[i], d.b[i], d.often[i].astype(np.uint8), numbers[i])) for p, i in dealt(d.a, parts)]


# ---------------------------------------------------------------- the stages


def _heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cores with many different windows in a unit, and how many."""
    for batch in batches:
        for unit in _units_in(batch):
            core, context, _, _ = unit.windows()
            d = _different(core, context)
            cores, n = np.unique(d.a, return_counts=True)
            many = n >= LOCALLY_MANY
            yield pa.RecordBatch.from_arrays([pa.array(cores[many].view(np.int64)), pa.array(n[many].astype(np.int64))],
                                             names=["core", "n"])


def _ask(parts: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        for batch in batches:
            for unit in _units_in(batch):
                core, context, low, high = unit.windows()
                is_hot = _is_in(core, hot)
                rows = _deal_keys(_different(core[~is_hot], context[~is_hot]), WINDOWS, unit.number, parts)
                if is_hot.any():
                    starts = _string_starts(unit, np.flatnonzero(is_hot), low, high)
                    rows += _deal_keys(_strings(unit, starts), STRINGS, unit.number, parts)
                yield _rows(rows)
    return run


def _met(values: list[tuple[int, bytes]]):
    """The keys of several units, sorted: a, b, unit, number, first of its key,
    and whether the key was met more than once."""
    got = [(u, unpack_keys(x, "u8", "u1", "u4")) for u, x in values]
    a, b, often, number = (np.concatenate([g[i] for _, g in got]) for i in range(4))
    unit = np.repeat([u for u, _ in got], [len(g[0]) for _, g in got])
    order = np.lexsort((number, unit, b, a))
    a, b, often, number, unit = (x[order] for x in (a, b, often, number, unit))
    first = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    group = np.cumsum(first) - 1
    repeated = (np.bincount(group) > 1) | (np.bincount(group, weights=often) > 0)
    return a, b, unit, number, first, repeated[group]


def _to_units(kind: int, unit: np.ndarray, *columns: np.ndarray) -> list[tuple]:
    order = np.argsort(unit, kind="stable")
    cuts = np.flatnonzero(np.diff(unit[order])) + 1
    return [(0, kind, int(unit[own[0]]), pack(*(c[own] for c in columns))) for own in np.split(order, cuts) if len(own)]


def _values(rows: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    return [(u, x) for k, u, x in zip(*(rows.column(c).to_pylist() for c in ("kind", "unit", "packed")), strict=True) if k == kind]


def _codes(limit: int):
    """What each unit is told about its windows and strings."""
    def run(rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if asked := _values(rows, WINDOWS):
            core, _, unit, number, first, repeated = _met(asked)
            new = np.concatenate([[True], core[1:] != core[:-1]])
            group = np.cumsum(new) - 1
            contexts = np.bincount(group, weights=first)[group]
            code = np.where(repeated, ALL, 0)
            code |= np.where((contexts > 1) & (contexts <= limit) & first, SEND, 0)
            code |= np.where((contexts > limit) & ~repeated, APART, 0)
            code |= np.where((contexts > limit) & repeated & first, APART, 0)
            told = code > 0
            out += _to_units(CODES, unit[told], number[told], code[told].astype(np.uint8))
        if asked := _values(rows, STRINGS):
            _, _, unit, number, _, repeated = _met(asked)
            out += _to_units(STRINGS, unit[repeated], number[repeated])
        return pa.Table.from_batches([_rows(out)])
    return run


def _code_of(codes: pa.Table, n: int) -> np.ndarray:
    code = np.zeros(n, np.uint8)
    for _, x in _values(codes, CODES):
        number, c = unpack(x, "u4", "u1")
        code[number] |= c
    return code


def _send(parts: int, shared):
    """A unit's windows that are to be sorted, and strings to be dealt apart."""
    def run(units: pa.Table, codes: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for unit in _units_in(units):
            core, context, low, high = unit.windows()
            cold = np.flatnonzero(~_is_in(core, shared.value))
            d = _different(core[cold], context[cold])
            code = _code_of(codes, len(d.a))
            send = np.flatnonzero(code & SEND)
            at = cold[d.first[send]]
            for p, i in dealt(core[at], parts):
                w = at[i]
                left = unit.places[w] - low[w]
                right = high[w] - unit.places[w] - CORE
                data = b"".join(unit.text[low[x]:unit.places[x]].tobytes() + unit.text[unit.places[x] + CORE:high[x]].tobytes()
                                for x in w.tolist())
                out.append((p, SENT, unit.number, pack_keys(
                    core[w], send[i].astype(np.uint32), (code[send[i]] & ALL).astype(np.uint8),
                    left.astype(np.uint8), right.astype(np.uint8)) + b"" + _tail(data)))
            if (apart := np.flatnonzero((code & APART)[d.number] > 0)).size:
                starts = _string_starts(unit, cold[apart], low, high)
                out += _deal_keys(_strings(unit, starts), LATE_STRINGS, unit.number, parts)
        return pa.Table.from_batches([_rows(out)])
    return run


def _tail(data: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=3).compress(data)
    return packed + len(packed).to_bytes(8, "little")


def _split_tail(value: bytes) -> tuple[bytes, bytes]:
    n = int.from_bytes(value[-8:], "little")
    return value[:-8 - n], zstandard.ZstdDecompressor().decompress(value[-8 - n:-8]) if n else b""


def _common(values: list[bytes]) -> int:
    """Length of the common prefix."""
    low, high = min(values), max(values)
    n = min(len(low), len(high))
    return next((i for i in range(n) if low[i] != high[i]), n)


def shared_starts(windows: list[tuple[bytes, bytes]]) -> list[int]:
    """For each window (context left and right of a common core) the bits of
    the starts whose string another window has at the same place.

    Bit o stands for the start CONTEXT - o bytes before the core. The core, and
    the context that all windows share next to it, is one symbol here; the
    windows follow each other, and a suffix array brings equal strings next to
    each other. A string is a suffix's first symbols, as many as its start
    needs, and they never reach over the window's end.
    """
    lefts, rights = [w[0] for w in windows], [w[1] for w in windows]
    a, b = _common([x[::-1] for x in lefts]), _common(rights)
    text: list[int] = []
    owner: list[int] = []
    middle: list[int] = []
    for j, (left, right) in enumerate(windows):
        own = left[:len(left) - a]
        middle.append(len(text) + len(own))
        text += [x + 2 for x in own]
        text.append(1)
        text += [x + 2 for x in right[b:]]
        text.append(0)
        owner += [j] * (len(text) - len(owner))
    raw = np.array(text, np.uint16).tobytes()
    masks = [0] * len(windows)
    reach = [-1] * len(windows)  # symbols after the middle that a neighbour shares
    starts = [i for i in suffix_array(text) if i <= middle[owner[i]]]
    for x, y in zip(starts, starts[1:]):
        jx, jy = owner[x], owner[y]
        ox, oy = middle[jx] - x, middle[jy] - y
        if ox != oy:
            continue
        if ox:  # the start is `ox` symbols before the middle
            o = CONTEXT - a - ox
            need = max(0, o - b)
            if min(len(rights[jx]), len(rights[jy])) < o:
                continue
            n = ox + 1 + need
            if raw[2 * x:2 * (x + n)] == raw[2 * y:2 * (y + n)]:
                masks[jx] |= 1 << o
                masks[jy] |= 1 << o
        else:
            r = _common([rights[jx][b:], rights[jy][b:]]) + b
            reach[jx], reach[jy] = max(reach[jx], r), max(reach[jy], r)
    for j, r in enumerate(reach):  # starts within what all share on the left
        for o in range(CONTEXT - a, min(r, CONTEXT) + 1):
            masks[j] |= 1 << o
    return masks


def _sort(rows: pa.Table) -> pa.Table:
    """The starts each sent window shares with another, and repeated strings."""
    out: list[tuple] = []
    if sent := _values(rows, SENT):
        unit, number, mask = [], [], []
        got = []
        for u, value in sent:
            head, data = _split_tail(value)
            core, num, known, left, right = unpack_keys(head, "u4", "u1", "u1", "u1")
            ends = np.cumsum(left.astype(np.int64) + right)
            got.append((np.full(len(core), u), core, num, known, left, ends - right - left, ends, np.full(len(core), len(got)), data))
        core, num, known, left, lo, hi, which = (np.concatenate([g[i] for g in got]) for i in range(1, 8))
        units = np.concatenate([g[0] for g in got])
        order = np.lexsort((num, units, core))
        cuts = np.flatnonzero(np.diff(core[order])) + 1
        for own in np.split(order, cuts):
            windows = []
            for i in own.tolist():
                data, at = got[which[i]][8], int(lo[i])
                windows.append((data[at:at + int(left[i])], data[at + int(left[i]):int(hi[i])]))
            for i, m in zip(own.tolist(), shared_starts(windows), strict=True):
                if m and not known[i]:
                    unit.append(units[i])
                    number.append(num[i])
                    mask.append(m)
        out += _to_units(MASKS, np.array(unit, np.int64), np.array(number, np.uint32), np.array(mask, np.uint64))
    if asked := _values(rows, LATE_STRINGS):
        _, _, unit, number, _, repeated = _met(asked)
        out += _to_units(LATE_STRINGS, unit[repeated], number[repeated])
    return pa.Table.from_batches([_rows(out)])


def _cut(shared):
    """Mark and remove: one row per document of a unit."""
    def run(units: pa.Table, found: pa.Table) -> pa.Table:
        tables = []
        for unit in _units_in(units):
            n = len(unit.text)
            core, context, low, high = unit.windows()
            is_hot = _is_in(core, shared.value)
            cold = np.flatnonzero(~is_hot)
            d = _different(core[cold], context[cold])
            code = _code_of(found, len(d.a))
            edge = np.zeros(n + 1, np.int32)  # +1 where a repeated string starts, -1 behind its end

            def mark(starts: np.ndarray) -> None:
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + LENGTH, -1)

            whole = cold[(code & ALL)[d.number] > 0]  # every byte of such a window that holds a string
            whole = whole[high[whole] - low[whole] >= LENGTH]
            np.add.at(edge, low[whole], 1)
            np.add.at(edge, high[whole], -1)
            masks = np.zeros(len(d.a), np.uint64)
            for _, x in _values(found, MASKS):
                number, m = unpack(x, "u4", "u8")
                masks[number] |= m
            own = masks[d.number]
            for o in range(WINDOW):
                at = cold[(own >> np.uint64(o) & np.uint64(1)) > 0]
                mark(unit.places[at] - CONTEXT + o)
            for kind, windows in ((STRINGS, np.flatnonzero(is_hot)), (LATE_STRINGS, cold[(code & APART)[d.number] > 0])):
                if told := _values(found, kind):
                    starts = _string_starts(unit, windows, low, high)
                    s = _strings(unit, starts)
                    again = np.zeros(len(s.a), bool)
                    for _, x in told:
                        again[unpack(x, "u4")[0]] = True
                    mark(starts[again[s.number]])
            gone = np.cumsum(edge[:n]) > 0
            begins = unit.ends - unit.sizes
            rise = gone & np.concatenate([[True], ~gone[:-1]]) if n else gone
            rise[begins[unit.sizes > 0]] = gone[begins[unit.sizes > 0]]
            removed = np.concatenate([[0], np.cumsum(gone)])
            spans = np.concatenate([[0], np.cumsum(rise)])
            digest = [hashlib.sha256(unit.text[x:y][~gone[x:y]].tobytes()).hexdigest()
                      for x, y in zip(begins.tolist(), unit.ends.tolist(), strict=True)]
            kept = [unit.text[x:y][~gone[x:y]].tobytes() for x, y in zip(begins.tolist(), unit.ends.tolist(), strict=True)]
            tables.append(pa.table({
                "key": pa.array(unit.keys, mask=unit.missing.astype(bool)), "n_bytes": pa.array(unit.sizes, pa.int64()),
                "n_removed": pa.array(removed[unit.ends] - removed[begins], pa.int64()),
                "n_spans": pa.array(spans[unit.ends] - spans[begins], pa.int64()),
                "kept_sha256": pa.array(digest, pa.string()), "kept": pa.array(kept, pa.binary())}))
        return pa.concat_tables(tables) if tables else pa.table({n: pa.array([], t) for n, t in _OUT})
    return run


_OUT = [("key", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()), ("kept", pa.binary())]


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_limit: int = GROUP_LIMIT,
                 hot_limit: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining
    bytes) of every row.

    A byte goes if a string of LENGTH bytes over it also starts anywhere else,
    in the same document too. Null and empty texts have no bytes. Repeated
    rows are documents each, so they lose all strings they share. A null id
    stays null. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    parts = PARTS_EACH * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("key"),
                       F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    units = written(rows.mapInArrow(_unit_rows, "unit long, docs binary, text binary, places binary, n_places long"),
                    "suffix-units")
    total = units.agg(F.coalesce(F.sum("n_places"), F.lit(0))).first()[0]
    limit = max(group_limit, total // FREQUENT) if hot_limit is None else hot_limit
    heavy = (units.mapInArrow(_heavy, "core long, n long").groupBy("core").agg(F.sum("n").alias("n"))
             .where(F.col("n") > limit).select("core").collect())  # at most total / limit
    hot = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in heavy], np.int64).view(np.uint64)))
    codes = written(units.mapInArrow(_ask(parts, hot), _ROWS).groupBy("part").applyInArrow(_codes(group_limit), _ROWS),
                    "suffix-codes")
    by_unit = units.groupBy("unit")
    sent = by_unit.cogroup(codes.where(F.col("kind") == CODES).groupBy("unit")).applyInArrow(_send(parts, hot), _ROWS)
    found = sent.groupBy("part").applyInArrow(_sort, _ROWS).unionByName(codes)
    out = by_unit.cogroup(found.groupBy("unit")).applyInArrow(
        _cut(hot), "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumnRenamed("key", "doc_id")
