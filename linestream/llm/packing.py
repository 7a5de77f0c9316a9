"""Best-fit packing by patterns fitted with non-negative least squares.

Documents become token pieces of at most `capacity` tokens. Only the histogram
of piece lengths (at most `capacity` rows, whatever the input) goes to the
driver. There, patterns of few lengths that fill a sequence are listed, a
non-negative least-squares fit says how often each should be repeated, the
repeats are rounded down, and what is left of the histogram is packed best fit
in bulk (equal bins move together). The plan says, for each length, which run
of ranks fills which slot; the rows get their rank within their length in two
levels (count per bucket, then row number inside a bucket) and look up their
sequence and offset in the plan.

Documents that come in an order (a mix) are packed stretch by stretch of it,
each with a plan of its own, so the sequences follow the order.
"""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.running import running_sum
from ..operators.sizing import checked_broadcast
from .common import partitions_for, text_or_empty, written

CAPACITY = 2048
#: Words a Python worker keeps with their ids, in two generations of this size:
#: a full one becomes the old one, whose words come back when they are met again.
WORD_CACHE = 500_000
#: Bytes of words and ids that fill a generation too: what has no spaces is one word, however long.
CACHE_BYTES = 2**25
#: Rows of a batch that are Python objects at once.
ROWS_AT_ONCE = 200
#: Rows of one length are ranked in buckets of about this many.
ROWS_PER_BUCKET = 100_000
#: Documents of an order that are packed together.
STRETCH = 4096
#: Patterns of three that are listed for each length, besides the pair.
TRIPLES_PER_LENGTH = 6

#: Byte-level tokenizers write a byte that prints as itself, and the others, in
#: order, as the characters from 256 on (the public byte-level alphabet).
_PRINTS = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTS)}


class WordIds:
    """Ids of texts by a tokenizer that splits at white space before anything
    else and lower-cases: a text's ids are those of its space- and
    newline-separated words, each encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode, self.merge = tokenizer.encode_batch_fast, tokenizer.model.tokenize
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.new_bytes = 0

    def _ids(self, words: list[bytes]) -> list[bytes]:
        out: list = [None] * len(words)
        rest: list[tuple[int, str]] = []
        for i, raw in enumerate(words):
            w = raw.decode()
            if w.isalpha() and w.islower() and (w.isascii() or is_normalized("NFC", w)):
                # nothing to normalise and nothing to split: straight to the merges
                text = w if w.isascii() else raw.decode("latin-1").translate(_BYTE_LETTERS)
                out[i] = array("I", [t.id for t in self.merge(text)]).tobytes()
            else:
                rest.append((i, w))
        for (i, _), e in zip(rest, self.encode([w for _, w in rest], add_special_tokens=False), strict=True):
            out[i] = array("I", e.ids).tobytes()
        return out

    def _learn(self, words: set[bytes]) -> None:
        new, old = self.new, self.old
        unknown, closed = set(), []
        for w in words:
            if (ids := old.get(w)) is not None:
                new[w] = ids
                self.new_bytes += len(w) + len(ids)
                continue
            stem, end = w.rstrip(b".,"), w[len(w.rstrip(b".,")):]
            if end and stem.decode().lower().isalpha():  # letters and punctuation are encoded apart
                closed.append((w, stem, end))
                unknown.update(x for x in (stem, end) if x not in new)
            else:
                unknown.add(w)
        todo = list(unknown)
        new.update(zip(todo, self._ids(todo), strict=True))
        for w, stem, end in closed:
            new[w] = new[stem] + new[end]
        self.new_bytes += sum(len(w) + len(new[w]) for w in todo) + sum(len(w) + len(new[w]) for w, _, _ in closed)

    def of(self, text: str) -> bytes:
        """Ids as unsigned 32-bit numbers, little-endian, the closing id 0 included."""
        raw = text.encode()
        if b"<|" not in raw:  # special tokens are the one thing that is not lower-cased
            raw = raw.lower()
        words = raw.replace(b"\n", b" ").split(b" ")
        if len(self.new) > WORD_CACHE or self.new_bytes > CACHE_BYTES:
            self.old, self.new, self.new_bytes = self.new, {}, 0
        missing = set(words).difference(self.new)
        if missing:
            self._learn(missing)
        return b"".join(map(self.new.__getitem__, words)) + b"\0\0\0\0"


_encoders: dict[str, WordIds] = {}


def _pieces_of(path: str, capacity: int):
    step = capacity * 4
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = WordIds(path)
        encoder = _encoders[path]
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            position: list[int] = []
            few = (batch.slice(at, ROWS_AT_ONCE) for at in range(0, batch.num_rows, ROWS_AT_ONCE))
            for row, (doc_id, text) in enumerate(x for b in few for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                ids = memoryview(encoder.of(text or ""))
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    for c, v in zip(out, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        c.append(v)
                    position.append(row)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
            if batch.num_columns > 2:
                columns.append(batch.column(2).take(pa.array(position, pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=names + ["position"] * (batch.num_columns > 2))
    return run


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                 text_col: str = "text", position_col: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document (null text: empty), and position if it has one."""
    place = [F.col(f"`{position_col}`").cast("long").alias("position")] if position_col else []
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), *place)
    return rows.mapInArrow(_pieces_of(tokenizer, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long"
                           + ", position long" * bool(place))


# ---------------------------------------------------------------- the plan


def list_patterns(hist: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Pairs and triples of present lengths that fill a sequence, or come as
    close to it as the present lengths allow. Longest length first."""
    present = [int(x) for x in np.flatnonzero(hist) if 0 < x < capacity]
    found: set[tuple[int, ...]] = set()

    def at_most(x: int) -> int | None:
        i = bisect_left(present, x + 1) - 1
        return present[i] if i >= 0 else None

    for a in present:
        b = at_most(capacity - a)
        if b is not None:
            found.add(tuple(sorted((a, b), reverse=True)))
        room = capacity - a
        below = bisect_left(present, room)
        for j in np.unique(np.linspace(0, below - 1, TRIPLES_PER_LENGTH).astype(int)) if below else ():
            c = at_most(room - present[j])
            if c is not None:
                found.add(tuple(sorted((a, present[j], c), reverse=True)))
    return sorted(found, reverse=True)


def fit_repeats(patterns: list[tuple[int, ...]], hist: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Non-negative least squares by coordinate descent: repeats x >= 0 that
    minimise the squared gap between the patterns' use and the histogram."""
    x = np.zeros(len(patterns))
    left = hist.astype(float).copy()
    uses = []
    for p in patterns:
        lengths, counts = np.unique(p, return_counts=True)
        uses.append((lengths, counts.astype(float), float((counts ** 2).sum())))
    scale = max(1.0, float(hist.max(initial=0)))
    for _ in range(sweeps):
        moved = 0.0
        for k, (lengths, counts, norm) in enumerate(uses):
            new = max(0.0, x[k] + float(counts @ left[lengths]) / norm)
            if new != x[k]:
                left[lengths] -= counts * (new - x[k])
                moved = max(moved, abs(new - x[k]))
                x[k] = new
        if moved < 1e-3 * scale:
            break
    return x


def make_plan(hist: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, how many such sequences), using up the histogram."""
    left = hist.astype(np.int64).copy()
    plan: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        plan.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    patterns = list_patterns(left, capacity)
    repeats = fit_repeats(patterns, left)
    for k in np.argsort(-repeats, kind="stable"):
        lengths, counts = np.unique(patterns[k], return_counts=True)
        n = min(int(repeats[k]), int((left[lengths] // counts).min()))
        # a pattern with waste is left to best fit, which may fill it better
        if n > 0 and sum(patterns[k]) == capacity:
            plan.append((patterns[k], n))
            left[lengths] -= counts * n
    return plan + best_fit(left, capacity)


def best_fit(hist: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: equal bins are one entry with a number."""
    bins: dict[int, list[list]] = {}  # room left -> [lengths, number]
    rooms: list[int] = []
    for length in range(capacity, 0, -1):
        todo = int(hist[length])
        while todo:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                lengths, number = bins[room].pop()
                if not bins[room]:
                    del bins[room]
                    rooms.pop(i)
                fit = room // length
                if todo >= fit * number:  # every one of these bins takes as many as it can
                    each, used = fit, number
                elif todo >= number:
                    each, used = todo // number, number
                else:
                    each, used = 1, todo
                if used < number:
                    _put(bins, rooms, room, [lengths, number - used])
            else:
                fit = capacity // length
                each, used = (fit, todo // fit) if todo >= fit else (todo, 1)
                lengths, room = (), capacity
            todo -= each * used
            _put(bins, rooms, room - each * length, [lengths + (length,) * each, used])
    return [(tuple(lengths), number) for group in bins.values() for lengths, number in group]


def _put(bins: dict, rooms: list[int], room: int, entry: list) -> None:
    if room not in bins:
        bins[room] = []
        insort(rooms, room)
    bins[room].append(entry)


def lookup_of(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: where runs of ranks begin, and the sequence and offset
    of each run's first member (the next member goes to the next sequence)."""
    taken: dict[int, int] = {}
    runs: dict[int, list[tuple[int, int, int]]] = {}
    base = 0
    for lengths, number in plan:
        offset = 0
        for length in lengths:
            runs.setdefault(length, []).append((taken.get(length, 0), base, offset))
            taken[length] = taken.get(length, 0) + number
            offset += length
        base += number
    return {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v, strict=True)) for k, v in runs.items()}


# ---------------------------------------------------------------- on Spark


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32).

    Sequences are gapless from offset 0 and hold at most `capacity` tokens.
    """
    spark = pieces.sparkSession
    pieces = written(pieces, "pack-pieces")
    counts = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    hist = np.zeros(capacity + 1, dtype=np.int64)
    for r in counts:
        hist[r["length"]] = r["count"]
    table = spark.sparkContext.broadcast(lookup_of(make_plan(hist, capacity)))

    buckets = partitions_for(spark, int(hist.max()), ROWS_PER_BUCKET)
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    rows = pieces.withColumn("bucket", bucket)
    before = (rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
              .select("length", "bucket", F.coalesce(F.sum("n").over(
                  Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
                  F.lit(0)).alias("before")))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = (rows.withColumn("inside", inside).join(before, ["length", "bucket"])
              .withColumn("rank", F.col("before") + F.col("inside") - 1))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        seq, off = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order])) + 1
        for at in np.split(order, cuts) if len(order) else ():
            first, base, offset = table.value[int(lengths[at[0]])]
            i = np.searchsorted(first, ranks[at], side="right") - 1
            seq[at], off[at] = base[i] + ranks[at] - first[i], offset[i]
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    return (ranked.withColumn("_at", place("length", "rank"))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "_at.sequence_id", "_at.offset"))


def place_stretch(pieces: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Sequences (from 0) and offsets of one stretch's pieces, the sequences by the mean position of their tokens."""
    pieces = pieces.sort_values(["position", "piece"], kind="stable", ignore_index=True)
    lengths = pieces["length"].to_numpy()
    rank = pieces.groupby("length").cumcount().to_numpy()
    table = lookup_of(make_plan(np.bincount(lengths, minlength=capacity + 1), capacity))
    seq, off = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
    for length, at in pieces.groupby("length").indices.items():
        first, base, offset = table[int(length)]
        i = np.searchsorted(first, rank[at], side="right") - 1
        seq[at], off[at] = base[i] + rank[at] - first[i], offset[i]
    position = pieces["position"].to_numpy() - pieces["position"].iloc[0]
    mean = np.bincount(seq, weights=position * lengths) / np.bincount(seq, weights=lengths)
    number = np.empty(len(mean), np.int64)
    number[np.argsort(mean, kind="stable")] = np.arange(len(mean))
    return pieces.assign(sequence_id=number[seq], offset=off)


def pack_in_order(pieces: DataFrame, capacity: int = CAPACITY, stretch: int | None = None, documents: int = 0) -> DataFrame:
    """`pack` for pieces with a position (gapless numbers of the documents):
    the sequences of a stretch of positions come before those of the next.
    A task gets one stretch or a few, by the number of documents: the work is
    in the plans, not in the bytes that partitions are otherwise merged by."""
    tasks = partitions_for(pieces.sparkSession, documents, stretch or STRETCH)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = pieces.withColumn("stretch", F.floor(F.col("position") / (stretch or STRETCH)))
    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, position long, stretch long, "
              "sequence_id long, offset long")

    def place(group: pa.Table) -> pa.Table:
        # ids stay in Arrow, so that a null id does not turn the others into floats
        order = group.select(["position", "piece", "length"]).to_pandas()
        order["row"] = np.arange(len(order))
        done = place_stretch(order, capacity)
        out = group.take(pa.array(done["row"].to_numpy()))
        return out.append_column("sequence_id", pa.array(done["sequence_id"].to_numpy())).append_column(
            "offset", pa.array(done["offset"].to_numpy()))

    placed = written(rows.repartition(tasks, "stretch").groupBy("stretch").applyInArrow(place, schema), "pack-stretches")
    sizes = placed.groupBy("stretch").agg((F.max("sequence_id") + 1).alias("n"))  # a row a stretch
    upto = running_sum(sizes, [], "stretch", F.col("n"), "upto")
    before, _small = checked_broadcast(upto.select("stretch", (F.col("upto") - F.col("n")).alias("before")))
    return placed.join(before, "stretch").select(
        *names, (F.col("before") + F.col("sequence_id")).alias("sequence_id"), "offset")


def best_fit_packing(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                     text_col: str = "text", position_col: str | None = None) -> DataFrame:
    """Pack all documents into as few sequences of `capacity` tokens as it can.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. A document is its ids and a closing 0; only longer ones are cut,
    into full pieces and a last shorter one. Null and empty text: one piece of
    length 1. A null id stays null; repeated rows are packed each. An empty
    table gives no rows. Other columns of the input are not read. With
    `position_col` (gapless numbers from 0) the sequences follow that order.
    """
    if position_col:
        return pack_in_order(token_pieces(docs, tokenizer, capacity, id_col, text_col, position_col), capacity, documents=docs.count())
    return pack(token_pieces(docs, tokenizer, capacity, id_col, text_col), capacity)
