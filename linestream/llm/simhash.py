"""SimHash near-dedup by anchor points of a covering code.

The anchors are the words of a product of two binary Golay codes (23 bits,
covering radius 3 each) over bits 0-45 of the fingerprint. Every fingerprint
is replicated to the anchors within covering radius plus threshold: an anchor
whose distance exceeds the radius by e1 and e2 in the two blocks is taken if
e1 + e2 <= threshold. A neighbour within the threshold has its nearest anchor
among these, so each linked pair meets at an anchor and is compared there on
all 64 bits. That is about 61 replicas over 2^24 anchors for two bits.

Equal fingerprints are one node. An anchor that is the nearest one of more
than `HOT_HOMES` fingerprints is split exactly: its members go to the values
of threshold + 1 segments of the other 18 bits, one of which two neighbours
must share. A task reports at most a spanning forest of the links it finds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions_for, written
from .graph import components

SEED = 42
#: Nearest-anchor members beyond which an anchor is split by the other bits.
HOT_HOMES = 50_000
#: Hot anchors that are sent to every task, at most (the bound above grows with the input to hold this).
HOT_ANCHORS = 100_000
#: Fingerprints a replicating or comparing partition is sized for.
PRINTS_PER_PARTITION = 50_000
#: Groups up to this size are compared pair by pair, larger ones through one-bit variants.
SMALL_GROUP = 128
_SHINGLES_AT_ONCE = 1 << 18

# ---------------------------------------------------------------- fingerprints


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a text's word shingles (ASCII lower case and white space)."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _SHINGLES_AT_ONCE):
        part = words[at:at + _SHINGLES_AT_ONCE + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)), strict=False))
        h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 extra: Column | None = None) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a signed long) of every row; null
    text: 0. `extra` is a long that goes along."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_signed(fingerprint(t or b"", shingle)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), *batch.columns[2:]],
                                             names=["doc_id", "fp", *batch.schema.names[2:]])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"),
                       *([] if extra is None else [extra.alias("extra")]))
    return rows.mapInArrow(run, "doc_id long, fp long" + ("" if extra is None else ", extra long"))


# ---------------------------------------------------------------- anchors

BLOCK, CHECK, RADIUS = 23, 11, 3
#: Generator polynomial of the binary Golay code.
GENERATOR = 0xC75
_LOW = (1 << BLOCK) - 1


def _remainder(v: int) -> int:
    for bit in range(BLOCK - 1, CHECK - 1, -1):
        if v >> bit & 1:
            v ^= GENERATOR << (bit - CHECK)
    return v


@lru_cache(maxsize=4)
def _tables(threshold: int):
    """Syndromes of the low 12 and high 11 bits; and for each excess over the
    radius, by syndrome, the error patterns that lead to an anchor."""
    low = np.array([_remainder(v) for v in range(1 << 12)], np.int64)
    high = np.array([_remainder(v << 12) for v in range(1 << 11)], np.int64)
    by: list[list[list[int]]] = [[[] for _ in range(1 << CHECK)] for _ in range(threshold + 1)]
    bits = [_remainder(1 << i) for i in range(BLOCK)]
    for weight in range(RADIUS + threshold + 1):
        for on in combinations(range(BLOCK), weight):
            s = e = 0
            for i in on:
                s, e = s ^ bits[i], e | 1 << i
            by[max(0, weight - RADIUS)][s].append(e)
    ragged = []
    for lists in by:
        count = np.array([len(x) for x in lists], np.int64)
        ragged.append((count, np.cumsum(count) - count, np.array([e for x in lists for e in x], np.int64)))
    return low, high, ragged


def _blocks(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u = fp.view(np.uint64)
    return (u & np.uint64(_LOW)).astype(np.int64), (u >> np.uint64(BLOCK) & np.uint64(_LOW)).astype(np.int64)


def _syndrome(v: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low[v & 0xFFF] ^ high[v >> 12]


def _name(c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
    return (c1 >> CHECK) << 12 | c2 >> CHECK


def home(fp: np.ndarray) -> np.ndarray:
    """The nearest anchor of each fingerprint (the code is perfect: there is one)."""
    low, high, ragged = _tables(0)
    _, first, patterns = ragged[0]
    a, b = _blocks(fp)
    return _name(a ^ patterns[first[_syndrome(a, low, high)]], b ^ patterns[first[_syndrome(b, low, high)]])


def anchors(fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into fp, anchor) for every anchor within radius plus threshold."""
    low, high, ragged = _tables(threshold)
    a, b = _blocks(fp)
    sa, sb = _syndrome(a, low, high), _syndrome(b, low, high)
    index, names = [], []
    for x in range(threshold + 1):
        for y in range(threshold + 1 - x):
            (na, fa, pa_), (nb, fb, pb) = ragged[x], ragged[y]
            n = na[sa] * nb[sb]
            i = np.repeat(np.arange(len(fp)), n)
            k = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            width = nb[sb][i]
            c1 = a[i] ^ pa_[fa[sa[i]] + k // width]
            c2 = b[i] ^ pb[fb[sb[i]] + k % width]
            index.append(i)
            names.append(_name(c1, c2))
    return np.concatenate(index), np.concatenate(names)


def _replicas(hot, threshold: int):
    """Rows (bucket, fp); a hot anchor's bucket also names a segment's value."""
    width = 18 // (threshold + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = np.array(sorted(hot.value), np.int64)
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for at in range(0, len(fps), 4096):
                fp = fps[at:at + 4096]
                i, name = anchors(fp, threshold)
                fp = fp[i]
                if len(split):
                    is_hot = split[np.minimum(np.searchsorted(split, name), len(split) - 1)] == name
                    rest = (fp[is_hot].view(np.uint64) >> np.uint64(2 * BLOCK)).astype(np.int64)
                    parts, keep = [], [fp[~is_hot]]
                    for s in range(threshold + 1):
                        value = rest >> (s * width) & ((1 << width) - 1)
                        parts.append(name[is_hot] | (1 + (s << width) + value) << 24)
                        keep.append(fp[is_hot])
                    name, fp = np.concatenate([name[~is_hot], *parts]), np.concatenate(keep)
                yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(fp)], names=["bucket", "fp"])
    return run


# ---------------------------------------------------------------- comparing


class Forest:
    """Spanning forest of the links seen so far."""

    def __init__(self):
        self.up: dict[int, int] = {}
        self.kept: list[tuple[int, int]] = []

    def _root(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = x = up.get(p, p)
        return x

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            rx, ry = self._root(x), self._root(y)
            if rx != ry:
                self.up[rx] = ry
                self.kept.append((x, y))


def _pairs_by_shift(bucket: np.ndarray, fp: np.ndarray, size: np.ndarray, threshold: int, forest: Forest) -> None:
    """Compare all pairs of each (small) group: rows i and i + shift."""
    shift = 1
    keep = size > 1
    bucket, fp, size = bucket[keep], fp[keep], size[keep]
    while len(fp):
        same = np.flatnonzero(bucket[:-shift] == bucket[shift:])
        near = same[np.bitwise_count(fp[same] ^ fp[same + shift]) <= threshold]
        if len(near):
            forest.add(fp[near].view(np.int64), fp[near + shift].view(np.int64))
        shift += 1
        if not len(same):
            break


def _pairs_by_variants(fp: np.ndarray, threshold: int, forest: Forest) -> None:
    """Links of a large group without all pairs: fingerprints within two bits
    share a variant with one bit changed at most. Variants are met in slices of
    their hash, so memory stays a small multiple of the group."""
    fp = np.unique(fp)
    if threshold != 2:  # the general form: sorted blocks against each other
        for at in range(0, len(fp), 2048):
            part = fp[at:at + 2048]
            for to in range(at, len(fp), 2048):
                i, j = np.nonzero(np.bitwise_count(part[:, None] ^ fp[None, to:to + 2048]) <= threshold)
                off = at + i < to + j
                forest.add(part[i[off]].view(np.int64), fp[to + j[off]].view(np.int64))
        return
    masks = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])
    mix = np.uint64(0x9E3779B97F4A7C15)
    slices = max(1, len(fp) // 20_000)
    for s in range(slices):
        z, f = [], []
        for m in masks:
            v = fp ^ m
            own = np.flatnonzero((v * mix >> np.uint64(40)) % np.uint64(slices) == np.uint64(s)) if slices > 1 else slice(None)
            z.append(v[own])
            f.append(fp[own])
        z, f = np.concatenate(z), np.concatenate(f)
        order = np.argsort(z, kind="stable")
        z, f = z[order], f[order]
        same = np.flatnonzero(z[1:] == z[:-1])
        forest.add(f[same].view(np.int64), f[same + 1].view(np.int64))


def _compare(threshold: int):
    """Links found at each bucket of a partition sorted by bucket."""
    def links_of(bucket: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
        forest = Forest()
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        sizes = np.diff(np.append(starts, len(bucket)))
        size = np.repeat(sizes, sizes)
        small = size <= SMALL_GROUP
        fp = fp.view(np.uint64)
        _pairs_by_shift(bucket[small], fp[small], size[small], threshold, forest)
        for k in np.flatnonzero(sizes > SMALL_GROUP):
            _pairs_by_variants(fp[starts[k]:starts[k] + sizes[k]], threshold, forest)
        if not forest.kept:
            return None
        a, b = zip(*forest.kept, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # the bucket that may go on in the next batch
        for batch in batches:
            bucket, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(bucket):
                continue
            cut = int(np.searchsorted(bucket, bucket[-1]))
            if cut or (held and held[-1][0][-1] != bucket[0]):
                held.append((bucket[:cut], fp[:cut]))
                out = links_of(*(np.concatenate(x) for x in zip(*held, strict=True)))
                if out is not None:
                    yield out
                held = []
            held.append((bucket[cut:], fp[cut:]))
        if held:
            out = links_of(*(np.concatenate(x) for x in zip(*held, strict=True)))
            if out is not None:
                yield out
    return run


def near_links(prints: DataFrame, threshold: int = 2, hot_homes: int = HOT_HOMES) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column fp) within
    `threshold` bits (0 to 3); a spanning set, never all pairs of a group."""
    spark = prints.sparkSession
    if not 0 <= threshold <= 3:
        raise ValueError("the threshold must be 0 to 3 bits")
    count = prints.count()
    hot_homes = max(hot_homes, count // HOT_ANCHORS)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(home(batch.column(0).to_numpy()))], names=["anchor"])

    hot = []
    if count > hot_homes:  # else no anchor can hold more
        hot = [r[0] for r in prints.select("fp").mapInArrow(homes, "anchor long").groupBy("anchor").count()
               .where(F.col("count") > hot_homes).select("anchor").collect()]  # fewer than HOT_ANCHORS
    shared = spark.sparkContext.broadcast(hot)
    parts = partitions_for(spark, count, PRINTS_PER_PARTITION)
    rows = prints.select("fp").mapInArrow(_replicas(shared, threshold), "bucket long, fp long")
    return (rows.repartition(parts, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(_compare(threshold), "a long, b long"))


def simhash_components(docs: DataFrame, shingle: int = 3, threshold: int = 2, id_col: str = "doc_id",
                       text_col: str = "text", hot_homes: int = HOT_HOMES) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    A component is what links of at most `threshold` differing bits reach;
    component_id is its smallest doc_id (null only if it has none). Null and
    empty texts have fingerprint zero and link like any other. Repeated rows
    give repeated results. An empty table gives no rows. Other columns are not
    read.
    """
    docs_fp = written(fingerprints(docs, shingle, id_col, text_col), "simhash-docs")
    prints = written(docs_fp.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-prints")
    named = _by_component(prints, F.min("low"), threshold, hot_homes).withColumnRenamed("best", "component_id")
    return (docs_fp.join(named, F.col("fp") == F.col("f"))
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def _by_component(prints: DataFrame, best: Column, threshold: int, hot_homes: int) -> DataFrame:
    """f, best: an aggregate of each fingerprint's component (prints: fp and what it reads)."""
    roots = components(near_links(prints, threshold, hot_homes))
    nodes = (prints.join(roots, F.col("fp") == F.col("node"), "left")
             .withColumn("root", F.coalesce("root", "fp")).drop("node"))
    found = nodes.groupBy("root").agg(best.alias("best")).withColumnRenamed("root", "r")
    return nodes.join(found, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "best")


def keep_one(docs: DataFrame, shingle: int = 3, threshold: int = 2, id_col: str = "doc_id", text_col: str = "text",
             hot_homes: int = HOT_HOMES) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of each component
    the one with the smallest doc_id (then the smallest hash of its text; a
    null id last); of repeated rows one."""
    text = F.xxhash64(F.col(f"`{text_col}`").cast("string"))
    keyed = docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("hash"))
    fp = fingerprints(docs, shingle, id_col, text_col, text)
    rows = written(fp.groupBy("fp", "doc_id", "extra").agg(F.count(F.lit(1)).alias("n")), "simhash-docs")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "extra", "n")
    prints = written(rows.groupBy("fp").agg(F.min(key).alias("low")), "simhash-prints")
    named = _by_component(prints, F.min("low"), threshold, hot_homes)
    kept = written(named.select("best").distinct().select("best.doc_id", "best.extra", "best.n"), "simhash-kept")

    def those(kept: DataFrame) -> DataFrame:
        return keyed.join(kept, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("extra")), "left_semi")

    out = those(kept.where("n = 1"))
    if (repeated := kept.where("n > 1")).take(1):
        out = out.unionByName(those(repeated).groupBy("id", "hash").agg(F.any_value("row").alias("row")))
    return out.select("row.*")
