"""Language-model scoring with Katz backoff.

A text's tokens are its words and one end. Two orders: a token is predicted
from the one before it (a text's first from its start), and backs off to its
unigram. Counts r <= K are discounted by Good-Turing; the mass they give up in
a context goes to the tokens not seen there, in proportion to their unigrams,
with weights that make every context sum to exactly one. The unigram level
gives its mass to one event for all unknown words.

A word is named by 63 bits of its hash and a pair by 53 bits of its two words'
names, so every word has its own pairs, however rare it is and however large
the corpus. Counts of words and of pairs are stored tables. A context's weight
needs the unigrams of all that followed it: the pair table asks the word table
for the counts of its followers, sums by context, and its weights are stored.

Words counted at least N / 2**20 times (so at most 2**20 of them; and more, up to
a quarter of that number) are only cached: their numbers, unigrams and weights, and the pairs counted that often,
are sent to every task, so no part of a table holds a frequent key's rows. The
pairs of a frequent context are dealt by the pair, all others by the context.

Tables are dealt by a hash of the key into parts whose number follows the bytes
of text, not the session's partitions; a row holds one task's sorted keys and
values of one part (empty ones are not sent, so rows are never more than keys), packed in numpy and zstd, so a part is merged and looked
up with array operations. Counts are summed per task before they are dealt.
Scoring sends each lookup once per document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Bound on the words, and on the pairs, that are sent to every task.
FREQUENT = 1 << 20
#: Good-Turing discounts counts up to this one.
K = 5
#: Tokens or words a task holds before it deals them out.
TOKENS_AT_ONCE = 1_500_000
WORDS_AT_ONCE = 300_000
#: Bytes of text that are cut into words at once.
BYTES_AT_ONCE = 2_000_000
#: Parts of a table: one for about so many bytes of text, so that they follow the input alone, and so many at least.
BYTES_EACH = 12_000_000
LEAST_PARTS = 64
#: Tokens for each part of the pair table, at most.
TOKENS_EACH = 2_000_000

#: Bits of a pair's key. Keys meet only inside a part of bounded size, so a lookup finds a wrong pair once in about 10**10.
PAIR_BITS = 53

END = b"\n"  # not a possible word
_WORD = np.uint64(1 << 63)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)

# ---------------------------------------------------------------- packed rows


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length as one packed value (byte planes, zstd)."""
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns]
    return len(columns[0]).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(value: bytes, *dtypes: str) -> list[np.ndarray]:
    n = int.from_bytes(value[:8], "little")
    raw, at, out = zstandard.ZstdDecompressor().decompress(value[8:]), 0, []
    for d in map(np.dtype, dtypes):
        plane = np.frombuffer(raw, np.uint8, n * d.itemsize, at).reshape(d.itemsize, n)
        out.append(np.ascontiguousarray(plane.T).view(d).reshape(n))
        at += n * d.itemsize
    return out


def pack_keys(keys: np.ndarray, *values: np.ndarray) -> bytes:
    """Sorted keys go as differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)), *values)


def unpack_keys(value: bytes, *dtypes: str) -> list[np.ndarray]:
    keys, *values = unpack(value, "u8", *dtypes)
    return [np.cumsum(keys, dtype=np.uint64), *values]


def pack_weights(keys: np.ndarray, values: np.ndarray) -> bytes:
    """Sorted keys with values that repeat (most contexts had one follower): each value once, and its number for every key."""
    own, number = np.unique(values, return_inverse=True)
    first = pack_keys(keys, number.astype(np.uint32))
    return len(first).to_bytes(8, "little") + first + pack(own)


def unpack_weights(value: bytes) -> list[np.ndarray]:
    end = 8 + int.from_bytes(value[:8], "little")
    keys, number = unpack_keys(value[8:end], "u4")
    own, = unpack(value[end:], "f8")
    return [keys, own[number]]


def dealt(keys: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, indices) of sorted keys, their order kept."""
    part = ((keys * _MIX >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for own in np.split(order, cuts) if len(order) else ():
        yield int(part[own[0]]), own


# ---------------------------------------------------------------- tokens


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def word_key(word: bytes) -> int:
    """63 bits of the word's hash, the top bit set (so it is never a class number)."""
    return xxhash.xxh64_intdigest(word) | 1 << 63


class Numbers:
    """Class number of a frequent word, key of any other; bounded cache."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys  # sorted; class number = place + 1
        self.known: dict[bytes, int] = {}

    def learn(self, texts: list[list[bytes]]) -> None:
        if len(self.known) > WORDS_AT_ONCE:
            self.known.clear()
        new = list(set().union(*texts, (END,)).difference(self.known))
        key = np.fromiter(map(word_key, new), np.uint64, len(new))
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            key = np.where(self.keys[at] == key, at.astype(np.uint64) + np.uint64(1), key)
        self.known.update(zip(new, key.tolist(), strict=True))

    def of(self, words: list[bytes]) -> np.ndarray:
        """Numbers or keys of the words and the end."""
        out = np.empty(len(words) + 1, np.uint64)
        out[:-1] = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        out[-1] = self.known[END]
        return out


def contexts_of(numbers: np.ndarray, start: int) -> np.ndarray:
    """The number of what stands before every token of a text."""
    return np.concatenate([[np.uint64(start)], numbers[:-1]])


def pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    h = (v ^ v >> np.uint64(31)) * _MIX
    h = (h ^ h >> np.uint64(29)) * _MIX2 + w
    h = (h ^ h >> np.uint64(32)) * _MIX
    return (h ^ h >> np.uint64(29)) >> np.uint64(64 - PAIR_BITS)


def place_of(v: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """What a pair is dealt by: its context, or the pair itself if the context is frequent."""
    return np.where(v < _WORD, pair, v)


# ---------------------------------------------------------------- counting

_COUNT_ROWS = "part int, kind int, unit long, packed binary"
_STATS = ["total", "kinds", *(f"n{r}" for r in range(1, K + 2))]


def _row_batch(rows: list[tuple]) -> pa.RecordBatch:
    part, kind, unit, packed = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(unit, pa.int64()),
                                       pa.array(packed, pa.binary())], names=["part", "kind", "unit", "packed"])


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(inverse, weights=np.concatenate(counts), minlength=len(key)).astype(np.int64)


def _stored(part, keys: int, counts: np.ndarray, packed: bytes) -> pa.Table:
    small = np.bincount(counts[counts <= K + 1], minlength=K + 2)[1:]
    stats = [int(counts.sum()), keys, *small.tolist()]
    return pa.table({"part": pa.array([part], pa.int32()), "packed": pa.array([packed], pa.binary()),
                     **{n: pa.array([v], pa.int64()) for n, v in zip(_STATS, stats, strict=True)}})


def _merge_words(key: tuple, rows: pa.Table) -> pa.Table:
    got = [unpack_keys(x, "i8") for x in rows.column("packed").to_pylist()]
    keys, counts = _merge([g[0] for g in got], [g[1] for g in got])
    return _stored(key[0].as_py(), len(keys), counts, pack_keys(keys, counts))


def _merge_pairs(key: tuple, rows: pa.Table) -> pa.Table:
    v, w, n = (np.concatenate(x) for x in zip(*(unpack_keys(x, "u8", "i8") for x in rows.column("packed").to_pylist()), strict=True))
    pair, at, inverse = np.unique(pair_key(v, w), return_index=True, return_inverse=True)
    n = np.bincount(inverse, weights=n, minlength=len(pair)).astype(np.int64)
    v, w = v[at], w[at]
    order = np.argsort(v, kind="stable")
    return _stored(key[0].as_py(), len(n), n, pack_keys(v[order], w[order], n[order]))


def _summed(rows: DataFrame, merge, what: str) -> tuple[DataFrame, dict]:
    """Merge dealt counts into the stored table; its totals and counts of counts."""
    schema = "part int, packed binary, " + ", ".join(f"{n} long" for n in _STATS)
    table = written(rows.groupBy("part").applyInArrow(merge, schema), what)
    return table, table.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in _STATS]).first().asDict()


def _remove(table: DataFrame) -> None:
    """Delete the files of a table of our own (see `written`)."""
    spark, jvm = table.sparkSession, table.sparkSession.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _at_least(table: DataFrame, least: int, names: list[str]) -> list[np.ndarray]:
    """Keys (the columns `names`) counted at least `least` times, with their counts (at most total / least)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0).to_pylist():
                *keys, counts = unpack_keys(x, *["u8"] * (len(names) - 1), "i8")
                own = counts >= least
                yield pa.RecordBatch.from_arrays([*(pa.array(k[own].view(np.int64)) for k in keys), pa.array(counts[own])],
                                                 names=[*names, "n"])

    got = table.select("packed").mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "n"])).toPandas()
    return [*(got[c].to_numpy().astype(np.int64).view(np.uint64) for c in names), got["n"].to_numpy().astype(np.int64)]


def _least(table: DataFrame, keys: int, total: int) -> int:
    """From which count on rows are sent to every task: total / FREQUENT, so there are FREQUENT of
    them at most, or less, as long as a quarter of that is not passed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(64, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                found += np.bincount(np.log2(unpack_keys(x, *["u8"] * (keys - 1), "i8")[-1]).astype(np.int64), minlength=64)
        yield pa.RecordBatch.from_arrays([pa.array(range(64), pa.int32()), pa.array(found)], names=["power", "n"])

    rows = table.select("packed").mapInArrow(run, "power int, n long").groupBy("power").agg(F.sum("n").alias("n")).collect()
    above, least = 0, total // FREQUENT + 1
    for power, n in sorted(((r["power"], r["n"]) for r in rows), reverse=True):
        above += n
        if above > FREQUENT // 4:
            break
        least = min(least, 1 << power)
    return least


def discounts(n: dict, k: int = K) -> np.ndarray:
    """Good-Turing factors for counts 0..k (Katz's form, which leaves counts
    over k as they are). With too few counts of counts a smaller k is taken,
    and at last a discount of one half."""
    for k_ in range(k, 0, -1):
        c = [n[f"n{r}"] for r in range(1, k_ + 2)]
        if all(c) and (k_ + 1) * c[k_] < c[0]:
            a = (k_ + 1) * c[k_] / c[0]
            d = [((r + 1) * c[r] / (r * c[r - 1]) - a) / (1 - a) for r in range(1, k_ + 1)]
            if all(0 < x < 1 for x in d):
                return np.array([1.0, *d, *[1.0] * (k - k_)])
    return np.array([1.0] + [(r - 0.5) / r for r in range(1, k + 1)])


def _factor(d: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.where(counts <= K, d[np.minimum(counts, K)], 1.0)


# ---------------------------------------------------------------- the model


@dataclass
class Model:
    """What every task has at hand; all arrays are bounded by FREQUENT. The rest is in the tables."""

    tokens: int  # N
    words: int  # V
    keys: np.ndarray  # frequent words
    counts: np.ndarray  # of frequent words by number (0: not used)
    d1: np.ndarray
    d2: np.ndarray
    scale1: float  # below 1 only if the discounts free no mass
    log_unknown: float
    log_p1: np.ndarray  # by number; at 0 that of all other words together
    log_alpha: np.ndarray  # by number of the context (the last: a text's start)
    log_norm: np.ndarray  # log10 of what a discounted pair count is multiplied by
    hot: np.ndarray  # pairs counted very often, sorted
    hot_gain: np.ndarray

    @property
    def start(self) -> int:
        return len(self.log_p1)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.words + 1)))

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """log10 P(w) of words by count; a count of 0 is the unknown word."""
        c = np.maximum(counts, 1)
        return np.where(counts > 0, np.log10(_factor(self.d1, c) * c * self.scale1 / max(self.tokens, 1)), self.log_unknown)

    def seen(self, counts: np.ndarray) -> np.ndarray:
        """log10 of discounted pair counts."""
        return np.log10(_factor(self.d2, counts) * counts)


def weights(n: np.ndarray, kept: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 of a context's backoff weight and of what its discounted counts
    are multiplied by, from its count, its discounted counts and the unigram
    mass of its followers. The unknown word never followed, so some is left."""
    norm = np.where(kept < n * (1 - 1e-12), 1 / n, 1 / (n + 1))  # no count was discounted: as if one more were unseen
    return np.log10(np.maximum(1 - kept * norm, 1e-300) / np.maximum(1 - mass, 1e-300)), np.log10(norm)


def _text_rows(docs: DataFrame, key: Column, text_col: str) -> DataFrame:
    return docs.select(key.alias("key"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))


def _count_words(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def deal() -> pa.RecordBatch:
            key = np.fromiter(map(word_key, seen), np.uint64, len(seen))
            n = np.fromiter(seen.values(), np.int64, len(seen))
            order = np.argsort(key)
            key, n = key[order], n[order]
            return _row_batch([(p, 0, 0, pack_keys(key[i], n[i])) for p, i in dealt(key, parts)])

        for batch in batches:
            for text in batch.column(1).to_pylist():
                seen.update(words_of(text))
                seen[END] += 1
                if len(seen) > WORDS_AT_ONCE:
                    yield deal()
                    seen.clear()
        if seen:
            yield deal()
    return run


def _worded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Keys and words of some texts at a time: words take many times a text's bytes."""
    for batch in batches:
        begin, size = 0, 0
        lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
        for i, n in enumerate(lengths):
            size += n
            if size >= BYTES_AT_ONCE or i + 1 == len(lengths):
                rows = batch.slice(begin, i + 1 - begin)
                yield rows.column(0).to_pylist(), [words_of(t) for t in rows.column(1).to_pylist()]
                begin, size = i + 1, 0


def _count_pairs(parts: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shared.value
        numbers, start = Numbers(keys), len(keys) + 1
        held: list[np.ndarray] = []
        size = 0

        def deal() -> pa.RecordBatch:
            v, w = np.concatenate([contexts_of(x, start) for x in held]), np.concatenate(held)
            _, at, n = np.unique(pair_key(v, w), return_index=True, return_counts=True)
            at, n = at[order := np.argsort(v[at], kind="stable")], n[order]
            v, w = v[at], w[at]
            return _row_batch([(p, 0, 0, pack_keys(v[i], w[i], n[i].astype(np.int64)))
                               for p, i in dealt(place_of(v, pair_key(v, w)), parts)])

        for _, texts in _worded(batches):
            numbers.learn(texts)
            for words in texts:
                held.append(numbers.of(words))
                size += len(held[-1])
                if size > TOKENS_AT_ONCE:
                    yield deal()
                    held, size = [], 0
        if held:
            yield deal()
    return run


#: Kinds of rows: lookups of words and pairs, the tables' own rows, a unit's documents, sums by frequent context, and what scoring looks up.
ASK_WORD, ASK_PAIR, WORDS, PAIRS, DOCS, SUMS, FOLLOWERS, ALPHAS, GAINS, CONTEXTS = range(10)


def _as(table: DataFrame, kind: int, part: Column | str = "part") -> DataFrame:
    return table.select(F.col(part) if isinstance(part, str) else part, F.lit(kind).alias("kind"),
                        F.lit(0).cast("long").alias("unit"), "packed")


def _rare(w: np.ndarray) -> np.ndarray:
    return np.unique(w[w >= _WORD])


def _found(keys: np.ndarray, table: list[np.ndarray] | None, missing) -> np.ndarray:
    """Values of the keys in a table of sorted keys."""
    if table is None or not len(table[0]):
        return np.full(len(keys), missing)
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    return np.where(table[0][at] == keys, table[1][at], missing)


def _ask_followers(word_parts: int):
    """Each part of the pair table asks for the counts of its rare followers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rare = _rare(unpack_keys(x, "u8", "i8")[1])
                if len(rare):
                    yield _row_batch([(p, FOLLOWERS, part, pack_keys(rare[i])) for p, i in dealt(rare, word_parts)])
    return run


def _answer_followers(rows: pa.Table) -> pa.Table:
    packed, asks, table = rows.column("packed"), [], None
    for i, kind in enumerate(rows.column("kind").to_pylist()):
        if kind == WORDS:
            table = unpack_keys(packed[i].as_py(), "i8")
        else:
            asks.append(i)
    out = []
    for i in asks:
        keys, = unpack_keys(packed[i].as_py())
        out.append((rows.column("unit")[i].as_py(), FOLLOWERS, 0, pack_keys(keys, _found(keys, table, 0).astype(np.int64))))
    return _table(out)


def _table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_row_batch(rows)] if rows else [], _row_batch([(0, 0, 0, b"")]).schema)


def _part_of_pairs(rows: pa.Table, m: Model) -> tuple[np.ndarray, ...] | None:
    """One part of the pair table: contexts, counts, the followers' own counts, pair keys."""
    pairs, got = None, []
    for kind, x in zip(rows.column("kind").to_pylist(), rows.column("packed"), strict=True):
        if kind == PAIRS:
            pairs = unpack_keys(x.as_py(), "u8", "i8")
        elif kind == FOLLOWERS:
            got.append(unpack_keys(x.as_py(), "i8"))
    if pairs is None:
        return None
    v, w, n = pairs
    rare = w >= _WORD
    count = np.zeros(len(w), np.int64)
    count[~rare] = m.counts[w[~rare].astype(np.int64)]
    if got:
        keys, counts = (np.concatenate(x) for x in zip(*got, strict=True))
        order = np.argsort(keys)
        count[rare] = _found(w[rare], [keys[order], counts[order]], 0)
    return v, n, count, pair_key(v, w)


def _context_sums(v: np.ndarray, n: np.ndarray, log_p1: np.ndarray, d2: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Contexts, each row's place among them, and their counts, discounted counts and unigram mass."""
    who, inverse = np.unique(v, return_inverse=True)
    return who, inverse, [np.bincount(inverse, weights=x, minlength=len(who)) for x in (n, _factor(d2, n) * n, 10.0 ** log_p1)]


def _contexts(word_parts: int, shared):
    """Weights of a part's rare contexts, for the word table, sums of its frequent
    ones, and what scoring needs of the part's pairs: key, count, the follower's
    count and the context's place, and the numbers of the frequent contexts
    (0 for the others, whose sums are all in this part)."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        m: Model = shared.value
        if (part := _part_of_pairs(rows, m)) is None:
            return _table([])
        v, n, count, pair = part
        who, inverse, sums = _context_sums(v, n, m.unigram(count), m.d2)
        rare = who >= _WORD
        log_alpha, _ = weights(*(x[rare] for x in sums))
        order = np.argsort(pair)
        at = key[0].as_py()
        return _table([(at % word_parts, ALPHAS, 0, pack_weights(who[rare], log_alpha)),
                       (0, SUMS, 0, pack_keys(who[~rare], *(x[~rare] for x in sums))),
                       (word_parts + at, GAINS, 0, pack_keys(pair[order], n[order], count[order], inverse[order].astype(np.uint32))),
                       (word_parts + at, CONTEXTS, 0, pack(np.where(rare, 0, who).astype(np.uint32)))])
    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x in batch.column(0).to_pylist():
            v, *sums = unpack_keys(x, "f8", "f8", "f8")
            yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)), *map(pa.array, sums)], names=["v", "n", "kept", "mass"])


def learn(train: DataFrame, text_col: str = "text") -> tuple[Model, DataFrame, int, int]:
    """The model, its stored rows (words, contexts' weights, what pairs gain) by
    part, and the numbers of parts of words and of pairs (which
    are numbered after those of words)."""
    spark = train.sparkSession
    rows = _text_rows(train, F.lit(0).cast("long"), text_col)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    word_parts = max(LEAST_PARTS, -(-size // BYTES_EACH))
    word_table, n1 = _summed(rows.mapInArrow(_count_words(word_parts), _COUNT_ROWS), _merge_words, "katz-words")
    total = n1["total"]
    pair_parts = word_parts * max(1, -(-total // (word_parts * TOKENS_EACH)))  # a multiple: a context's part tells its word's
    frequent = _least(word_table, 1, total)
    keys, counts = _at_least(word_table, frequent, ["key"])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    d1 = discounts(n1)
    freed = sum(r * n1[f"n{r}"] * (1 - d1[r]) for r in range(1, K + 1))
    scale1 = 1.0 if freed > 0 or not total else total / (total + 1)
    p1 = np.concatenate([[0.0], _factor(d1, counts) * counts * scale1 / max(total, 1)])
    p1[0] = max(1.0 - p1.sum(), 1e-300)  # the words that are not frequent, and the unknown word
    unknown = freed / total if freed > 0 else 1 / (total + 1)
    if len(counts) == n1["kinds"]:
        p1[0] = unknown

    pair_rows = rows.mapInArrow(_count_pairs(pair_parts, spark.sparkContext.broadcast(keys)), _COUNT_ROWS)
    pair_table, n2 = _summed(pair_rows, _merge_pairs, "katz-pairs")
    model = Model(total, n1["kinds"], keys, np.concatenate([[0], counts]), d1, discounts(n2), scale1, float(np.log10(unknown)),
                  np.log10(p1), np.zeros(len(p1) + 1), np.zeros(len(p1) + 1), np.zeros(0, np.uint64), np.zeros(0))
    asks = pair_table.select("part", "packed").mapInArrow(_ask_followers(word_parts), _COUNT_ROWS)
    followers = written(asks.unionByName(_as(word_table, WORDS)).groupBy("part").applyInArrow(_answer_followers, _COUNT_ROWS),
                        "katz-followers")
    found = written(_as(pair_table, PAIRS).unionByName(followers).groupBy("part").applyInArrow(
        _contexts(word_parts, spark.sparkContext.broadcast(model)), _COUNT_ROWS), "katz-contexts")
    sums = (found.where(F.col("kind") == SUMS).select("packed").mapInArrow(_sums, "v long, n double, kept double, mass double")
            .groupBy("v").agg(*[F.sum(c).alias(c) for c in ("n", "kept", "mass")]).toPandas())  # a row a frequent word
    if len(sums):
        v = sums["v"].to_numpy(np.int64)
        model.log_alpha[v], model.log_norm[v] = weights(*(sums[c].to_numpy(float) for c in ("n", "kept", "mass")))
    # both words of such a pair are frequent
    hot_v, hot_w, hot_n = _at_least(pair_table, max(frequent, _least(pair_table, 2, total)), ["v", "w"])
    hot = pair_key(hot_v, hot_w)
    order = np.argsort(hot)
    v, w = hot_v[order].astype(np.int64), hot_w[order].astype(np.int64)
    model.hot = hot[order]
    model.hot_gain = model.seen(hot_n[order]) + model.log_norm[v] - model.log_alpha[v] - model.log_p1[w]
    stored = _as(word_table, WORDS).unionByName(found.where(F.col("kind").isin(ALPHAS, GAINS, CONTEXTS)))
    for table in (pair_table, followers):  # nothing reads them from here on
        _remove(table)
    return model, stored, word_parts, pair_parts


# ---------------------------------------------------------------- scoring

def _ask(word_parts: int, pair_parts: int, shared):
    """Score a unit of documents as far as the model goes, deal out the lookups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        numbers = Numbers(m.keys)
        base_of, task, units = m.base(m.counts), TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def deal() -> pa.RecordBatch:
            nonlocal units
            unit = task << 32 | units
            units += 1
            sizes = np.array([len(x) for _, x in held])
            number = np.concatenate([x for _, x in held])
            doc = np.repeat(np.arange(len(held), dtype=np.uint32), sizes)
            v = np.concatenate([contexts_of(x, m.start) for _, x in held])
            pair = pair_key(v, number)
            place = place_of(v, pair)
            # a rare word's unigram, and its weight as a context, are looked up with the word
            common, context = number < _WORD, v[v < _WORD].astype(np.int64)
            cls = number[common].astype(np.int64)
            score = (np.bincount(doc[v < _WORD], weights=m.log_alpha[context], minlength=len(held))
                     + np.bincount(doc[common], weights=m.log_p1[cls], minlength=len(held)))
            base = np.bincount(doc[common], weights=base_of[cls], minlength=len(held))
            known = np.bincount(doc[common], minlength=len(held)).astype(np.float64)
            rows = []
            order = np.argsort(pair, kind="stable")
            pair, pair_doc, place = pair[order], doc[order], place[order]
            if len(m.hot):
                at = np.minimum(np.searchsorted(m.hot, pair), len(m.hot) - 1)
                hot = m.hot[at] == pair
                score += np.bincount(pair_doc[hot], weights=m.hot_gain[at[hot]], minlength=len(held))
                pair, pair_doc, place = pair[~hot], pair_doc[~hot], place[~hot]
            rows += [(word_parts + p, ASK_PAIR, unit, pack_keys(pair[i], pair_doc[i])) for p, i in dealt(place, pair_parts)]
            word, word_doc = number[~common], doc[~common]
            order = np.argsort(word, kind="stable")
            word, word_doc = word[order], word_doc[order]
            rows += [(p, ASK_WORD, unit, pack_keys(word[i], word_doc[i])) for p, i in dealt(word, word_parts)]
            missing = np.array([k is None for k, _ in held], np.uint8)
            key = np.array([k or 0 for k, _ in held], np.int64)
            rows.append((unit % word_parts, DOCS, unit, pack(key, missing, sizes.astype(np.int64), score, base, known)))
            return _row_batch(rows)

        for keys, texts in _worded(batches):
            numbers.learn(texts)
            for key, words in zip(keys, texts, strict=True):
                held.append((key, numbers.of(words)))
                size += len(held[-1][1])
                if size > TOKENS_AT_ONCE:
                    yield deal()
                    held, size = [], 0
        if held:
            yield deal()
    return run


def _answer(shared):
    """Look up one part's questions; sums by unit and document go on."""
    def run(rows: pa.Table) -> pa.Table:
        m: Model = shared.value
        out, words, alphas, gains, pairs, contexts = [], None, [], None, None, None
        kinds, packed = rows.column("kind").to_pylist(), rows.column("packed")
        for i, kind in enumerate(kinds):
            if kind == WORDS:
                words = unpack_keys(packed[i].as_py(), "i8")
            elif kind == ALPHAS:
                alphas.append(unpack_weights(packed[i].as_py()))
            elif kind == GAINS:
                pairs = unpack_keys(packed[i].as_py(), "i8", "i8", "u4")
            elif kind == CONTEXTS:
                contexts, = unpack(packed[i].as_py(), "u4")
        if pairs is not None and ASK_PAIR in kinds:
            pair, n, count, who = pairs
            log_p1 = m.unigram(count)
            log_alpha, log_norm = weights(*(np.bincount(who, weights=x, minlength=len(contexts))
                                            for x in (n, _factor(m.d2, n) * n, 10.0 ** log_p1)))
            of_frequent = (m.log_norm - m.log_alpha)[contexts.astype(np.int64)]
            gains = [pair, m.seen(n) + np.where(contexts > 0, of_frequent, log_norm - log_alpha)[who] - log_p1]
        if alphas:
            keys, values = (np.concatenate(x) for x in zip(*alphas, strict=True))
            order = np.argsort(keys)
            alphas = [keys[order], values[order]]
        for i, kind in enumerate(kinds):
            unit = rows.column("unit")[i].as_py()
            if kind == DOCS:
                out.append((0, DOCS, unit, packed[i].as_py()))
            if kind not in (ASK_WORD, ASK_PAIR):
                continue
            key, doc = unpack_keys(packed[i].as_py(), "u4")
            who, inverse = np.unique(doc, return_inverse=True)
            if kind == ASK_WORD:
                n = _found(key, words, 0)
                values = (m.unigram(n) + _found(key, alphas or None, 0.0), m.base(n), n > 0)
            else:
                values = (_found(key, gains, 0.0),)
            out.append((0, kind, unit, pack(who, *[np.bincount(inverse, weights=x, minlength=len(who)) for x in values])))
        return _table(out)
    return run


def _finish(rows: pa.Table) -> pa.Table:
    """One unit's documents with their sums."""
    docs, add = None, []
    for kind, x in zip(rows.column("kind").to_pylist(), rows.column("packed").to_pylist(), strict=True):
        if kind == DOCS:
            docs = unpack(x, "i8", "u1", "i8", "f8", "f8", "f8")
        else:
            add.append(unpack(x, "u4", *["f8"] * (3 if kind == ASK_WORD else 1)))
    key, missing, sizes, *sums = docs
    score, base, known = (x.copy() for x in sums)
    # in a fixed order, so that a repeated task gives the same last digits
    for who, *sums in sorted(add, key=lambda x: (len(x), x[1].tobytes())):
        for total, part in zip((score, base, known), sums, strict=False):
            total[who] += part
    return pa.table({"key": pa.array(key, mask=missing.astype(bool)), "n_tokens": pa.array(sizes),
                     "n_known": pa.array(known.astype(np.int64)), "base_score": pa.array(base), "score": pa.array(score)})


def katz_scores(train: DataFrame, docs: DataFrame, key: Column, text_col: str = "text") -> DataFrame:
    """key, n_tokens, n_known, train_tokens, base_score, score of every row of
    `docs`, by a model of all rows of `train`.

    Null and empty texts are one end. With nothing to learn from, every token
    is the unknown word (score 0). Repeated rows count and are scored each.
    `key` is a long and may be null. Other columns are not read.
    """
    model, stored, word_parts, pair_parts = learn(train, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    asked = _text_rows(docs, key.cast("long"), text_col).mapInArrow(_ask(word_parts, pair_parts, shared), _COUNT_ROWS)
    # a task has a part or a few, however many partitions the session merges
    dealt_out = asked.unionByName(stored).repartition(word_parts + pair_parts, "part")
    answers = dealt_out.groupBy("part").applyInArrow(_answer(shared), _COUNT_ROWS)
    out = answers.groupBy("unit").applyInArrow(
        _finish, "key long, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(model.tokens).cast("long"))


#: Rows whose crc32(id as text) leaves this remainder are not learned from.
FOLDS, HELD_OUT = 5, 1


def held_out(id_col: str) -> Column:
    """A null id has no number and is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    out = katz_scores(docs.where(~held_out(id_col)), docs, F.col(f"`{id_col}`"), text_col)
    return out.select(F.col("key").alias("doc_id"), held_out("key").alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score")
