"""Cross-tokenizer alignment: inverted pair bitmaps.

Two tokenizers cut the same bytes; where a token of each ends at one byte, a
group ends. All tokens of a group are linked with all of the other tokenizer's.

A task numbers its documents, closes a block after `BLOCK` documents or
`POSTINGS` (pair, document) entries, and writes one row for each id pair of
the block: a compressed bitmap of the documents that hold it linked, and one
bitmap per binary digit of the links beyond the first (multiplicity planes). A
compressed bitmap is a sorted list of 16-bit places, or a bit set from
`DENSE` places on. Inside a block the entries of all its batches are ORed;
blocks hold different documents, so a pair's bitmap over the corpus is the
list of its blocks' bitmaps, its popcount their sum.

Spark then groups the rows by pair: popcounts give the number of documents and
of links, a grouping by the first tokenizer's id its best pairs. Last, every
posting takes its pair's count back to its block, where the planes turn into
sums for each document.

Sizes: pairs are bounded by the two vocabularies, a pair's rows by the blocks;
the join of postings and counts is of two written tables, so AQE can split a
pair that all blocks hold. A block's sums are two numbers a document.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions_for, written

#: Documents of a block (16-bit places), and entries after which a block ends early.
BLOCK = 1 << 16
POSTINGS = 3_000_000
#: Places from which on a bitmap is a bit set of BLOCK bits.
DENSE = BLOCK // 16
#: Characters that are encoded at once (one longer text goes alone).
CHARS_AT_ONCE = 250_000
#: Token pairs of one group that are listed one by one; larger groups go by their different ids.
PAIRS_LISTED = 10_000
#: Posting rows a scoring task is sized for.
ROWS_EACH = 2_000_000

#: Byte-level tokenizers write a byte that prints as itself, and the others, in
#: order, as the characters from 256 on (the public byte-level alphabet).
_PRINTS = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {chr(b): b for b in _PRINTS} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _PRINTS)}


#: The pattern that cuts text before the merges of a byte-level file (public, fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteTokens:
    """Ids and token bytes of a byte-level BPE file; special tokens' strings are plain text.

    Where the file's ids follow its merges (a token of a lower id is merged
    first) and its cutting pattern is the usual one, the ids come from tiktoken
    over the file's own vocabulary, which is the same and several times as fast."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, special = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes = [b""] * (max([*vocabulary.values(), *special.values()], default=-1) + 1)
        for token, i in (vocabulary | special).items():
            self.bytes[i] = bytes(_BYTES[c] for c in token) if all(c in _BYTES for c in token) else token.encode()
        self.tokenizer = self.ranked = None
        if self._ids_follow_merges(spec, vocabulary, special):
            import tiktoken

            ranks = {self.bytes[i]: i for token, i in vocabulary.items() if token not in special}
            self.ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        else:
            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.encode_special_tokens = True

    @staticmethod
    def _ids_follow_merges(spec: dict, vocabulary: dict, special: dict) -> bool:
        cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = (spec.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
                 and not cut.get("add_prefix_space") and not any(model.get(k) for k in (
                     "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        made = [vocabulary.get("".join(p)) for p in pairs]
        bytes_first = sorted(vocabulary.get(c, -1) for c in _BYTES) == list(range(256))
        return plain and bytes_first and made == list(range(256, 256 + len(made))) and len(vocabulary) - len(special) <= 256 + len(made)

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.ranked is not None:
            return [self.ranked.encode_ordinary(" " + t) for t in texts]
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class PieceTokens:
    """Ids and token bytes of a sentencepiece model, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
                      for i in range(m.get_piece_size())]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of every token, from the (rising) byte ends of both; the last ends are equal."""
    out = []
    for own, other in ((ends_a, ends_b), (ends_b, ends_a)):
        closes = other[np.minimum(np.searchsorted(other, own), len(other) - 1)] == own
        out.append(np.cumsum(closes) - closes)
    return out[0], out[1]


def _cross(group_a: np.ndarray, group_b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of every linked pair."""
    starts = np.cumsum(nb) - nb
    per = nb[group_a]
    i = np.repeat(np.arange(len(group_a)), per)
    within = np.arange(len(i)) - np.repeat(np.cumsum(per) - per, per)
    return i, np.repeat(starts[group_a], per) + within


def _links(ids_a, ids_b, group_a, group_b, doc_of, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """doc * 2**32 + pair of every different linked pair of a document, and its links. A pair is a * n_b + b."""
    n = int(group_a[-1]) + 1 if len(group_a) else 0
    na, nb = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    large = na * nb > PAIRS_LISTED
    small_a, small_b = ~large[group_a], ~large[group_b]
    ga, gb = group_a[small_a], group_b[small_b]
    i, j = _cross(ga, gb, np.where(large, 0, na), np.where(large, 0, nb))
    keys = [(doc_of[ga[i]] << 32) + ids_a[small_a][i] * n_b + ids_b[small_b][j]]
    times = [np.ones(len(i), np.int64)]
    for g in np.flatnonzero(large):  # e.g. a long run of one letter: few ids, many links
        a, ca = np.unique(ids_a[np.searchsorted(group_a, g):np.searchsorted(group_a, g, "right")], return_counts=True)
        b, cb = np.unique(ids_b[np.searchsorted(group_b, g):np.searchsorted(group_b, g, "right")], return_counts=True)
        keys.append((doc_of[g] << 32) + (a[:, None] * n_b + b[None, :]).ravel())
        times.append((ca[:, None] * cb[None, :]).ravel())
    return _summed(np.concatenate(keys), np.concatenate(times))


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, rising, with their sums (an OR of the entries' bits)."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def containers(places: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and end offsets of the compressed bitmaps that begin at `starts` in the rising `places`."""
    size = np.diff(starts, append=len(places))
    dense = np.flatnonzero(size >= DENSE)
    if not len(dense):
        return places.astype("<u2").view(np.uint8), np.cumsum(2 * size)
    parts, at = [], 0
    for c in dense:
        begin, end = starts[c], starts[c] + size[c]
        parts.append(places[at:begin].astype("<u2").view(np.uint8))
        bits = np.zeros(BLOCK, np.uint8)
        bits[places[begin:end]] = 1
        parts.append(np.packbits(bits, bitorder="little"))
        at = end
    parts.append(places[at:].astype("<u2").view(np.uint8))
    return np.concatenate(parts), np.cumsum(np.where(size >= DENSE, BLOCK // 8, 2 * size))


def places_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The inverse: places, and the number of the bitmap each is from."""
    size = np.diff(ends, prepend=0)
    dense = np.flatnonzero(size == BLOCK // 8)
    listed = np.where(size == BLOCK // 8, 0, size // 2)
    plain = np.ones(len(data), bool)
    for c in dense:
        plain[ends[c] - size[c]:ends[c]] = False
    places, owner = [data[plain].view("<u2").astype(np.int64)], [np.repeat(np.arange(len(ends)), listed)]
    for c in dense:
        found = np.flatnonzero(np.unpackbits(data[ends[c] - size[c]:ends[c]], bitorder="little"))
        places.append(found)
        owner.append(np.full(len(found), c))
    return np.concatenate(places), np.concatenate(owner)


#: One kind of row for a document, one for a pair of a block.
_ROWS = ("block long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "pair long, planes array<binary>")
_NAMES = [f.split()[0] for f in _ROWS.split(", ")]
_TYPES = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.int64(), pa.list_(pa.binary())]


class _Block:
    """The open block of a task: entries pair * BLOCK + place with their links."""

    def __init__(self):
        self.documents, self.size, self.parts = 0, 0, []

    def add(self, keys: np.ndarray, times: np.ndarray) -> None:
        pair, doc = keys & 0xFFFFFFFF, keys >> 32
        self.parts.append((pair * BLOCK + self.documents + doc, times))
        self.size += len(keys)

    def rows(self) -> tuple[pa.Array, pa.Array]:
        """Pairs and their planes: all documents, then the digits of links - 1."""
        keys, times = _summed(*(np.concatenate(c) for c in zip(*self.parts, strict=True)))
        pairs, pair_of = np.unique(keys // BLOCK, return_inverse=True)
        places, more = keys % BLOCK, times - 1
        plane, owner, place = [np.zeros(len(keys), np.int64)], [pair_of], [places]
        for digit in range(int(more.max()).bit_length()):
            has = np.flatnonzero(more >> digit & 1)
            plane.append(np.full(len(has), digit + 1))
            owner.append(pair_of[has])
            place.append(places[has])
        plane, owner, place = map(np.concatenate, (plane, owner, place))
        depth = int(plane.max()) + 1
        order = np.lexsort((place, owner * depth + plane))
        code, place = (owner * depth + plane)[order], place[order]
        starts = np.flatnonzero(np.diff(code, prepend=-1))
        # a digit that no document has, below one that some have, is an empty bitmap
        top = np.zeros(len(pairs), np.int64)
        np.maximum.at(top, code[starts] // depth, code[starts] % depth)
        planes_before = np.cumsum(top + 1) - (top + 1)
        data, ends = containers(place, starts)
        size = np.zeros(int((top + 1).sum()), np.int64)
        size[planes_before[code[starts] // depth] + code[starts] % depth] = np.diff(ends, prepend=0)
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        flat = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        lists = np.concatenate([planes_before, [len(size)]]).astype(np.int32)
        return pa.array(pairs, pa.int64()), pa.ListArray.from_arrays(pa.array(lists, pa.int32()), flat)


def _record(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(name, None) if name in columns else pa.nulls(n, t)
                                       for name, t in zip(_NAMES, _TYPES, strict=True)], names=_NAMES)


_tokens: dict = {}


def _chunks(texts: list) -> Iterator[tuple[int, int]]:
    """Runs of texts of about CHARS_AT_ONCE characters."""
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and (size + len(t or "") > CHARS_AT_ONCE or i - begin >= BLOCK // 16):
            yield begin, i
            begin, size = i, 0
        size += len(t or "")
    if begin < len(texts):
        yield begin, len(texts)


class Aligner:
    """Two tokenizers; the groups and links of texts."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), PieceTokens(path_b)
        self.n_b = max(len(self.b.bytes), 1)
        assert len(self.a.bytes) * self.n_b < 1 << 32, "a pair has 32 bits here"
        self.size_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.size_b = np.array([len(x) for x in self.b.bytes], np.int64)
        # a token's id with the mark behind it: inside its side, behind an A side, behind a group
        self.text_a = [b"%d%s" % (i, mark) for i in range(len(self.a.bytes)) for mark in (b",", b"|")]
        self.text_b = [b"%d%s" % (i, mark) for i in range(self.n_b) for mark in (b",", b";")]

    def align(self, texts: list) -> tuple[list[tuple], tuple[np.ndarray, np.ndarray]]:
        """(n_a, n_b, n_groups, n_links, groups_sha256) of each text, and its linked pairs (see `_links`)."""
        out: list = [(0, 0, 0, 0, "")] * len(texts)
        full = [i for i, t in enumerate(texts) if t]
        some = [texts[i] for i in full]
        good, all_a, all_b = [], [], []
        byte_a, byte_b = self.a.bytes, self.b.bytes
        for i, t, ids_a, ids_b in zip(full, some, self.a.encode(some), self.b.encode(some), strict=True):
            want = b" " + t.encode()
            if b"".join([byte_a[x] for x in ids_a]) == want == b"".join([byte_b[x] for x in ids_b]):
                good.append(i)
                all_a.append(ids_a)
                all_b.append(ids_b)
        if not good:
            return out, (np.zeros(0, np.int64), np.zeros(0, np.int64))
        len_a, len_b = (np.fromiter(map(len, x), np.int64, len(good)) for x in (all_a, all_b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())) for ids, n in ((all_a, len_a), (all_b, len_b)))
        group_a, group_b = groups_of(np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b]))
        n = int(group_a[-1]) + 1
        na, nb = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        ends_a, ends_b = np.cumsum(len_a), np.cumsum(len_b)
        ends_g = group_a[ends_a - 1] + 1
        sizes_g = np.diff(ends_g, prepend=0)
        doc_of = np.repeat(np.array(good, np.int64), sizes_g)
        links = np.add.reduceat(na * nb, ends_g - sizes_g)
        # written out group by group: the A tokens, then the B tokens
        before_a, before_b = np.cumsum(na) - na, np.cumsum(nb) - nb
        at_a = np.arange(len(ids_a)) + before_b[group_a]
        at_b = np.arange(len(ids_b)) + (before_a + na)[group_b]
        code = np.empty(len(ids_a) + len(ids_b), np.int64)
        code[at_a] = 2 * ids_a + (np.arange(len(ids_a)) == (before_a + na - 1)[group_a])
        code[at_b] = 2 * (ids_b + len(byte_a)) + (np.arange(len(ids_b)) == (before_b + nb - 1)[group_b])
        words, code = self.text_a + self.text_b, code.tolist()
        begin = 0
        for k, i in enumerate(good):
            end = int(ends_a[k] + ends_b[k])
            text = b"".join([words[c] for c in code[begin:end]])[:-1]
            out[i] = (int(len_a[k]), int(len_b[k]), int(sizes_g[k]), int(links[k]), hashlib.sha256(text).hexdigest())
            begin = end
        return out, _links(ids_a, ids_b, group_a, group_b, doc_of, self.n_b)


def _inverted(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if (path_a, path_b) not in _tokens:
            _tokens[path_a, path_b] = Aligner(path_a, path_b)
        aligner = _tokens[path_a, path_b]
        number = TaskContext.get().partitionId() << 32
        block = _Block()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for begin, end in _chunks(texts):
                size = end - begin
                if block.documents + size > BLOCK:
                    yield from _closed(block, number)
                    number, block = number + 1, _Block()
                found, links = aligner.align(texts[begin:end])
                block.add(*links)
                columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), _TYPES[3:8], strict=True)]
                yield _record(size, block=pa.array(np.full(size, number), pa.int64()),
                              place=pa.array(np.arange(block.documents, block.documents + size), pa.int32()),
                              doc_id=ids.slice(begin, size), **dict(zip(_NAMES[3:8], columns, strict=True)))
                block.documents += size
                if block.size >= POSTINGS:
                    yield from _closed(block, number)
                    number, block = number + 1, _Block()
        yield from _closed(block, number)
    return run


def _closed(block: _Block, number: int) -> Iterator[pa.RecordBatch]:
    if not block.size:
        return
    pairs, planes = block.rows()
    for at in range(0, len(pairs), 20_000):
        some = pairs.slice(at, 20_000)
        yield _record(len(some), block=pa.array(np.full(len(some), number), pa.int64()), pair=some, planes=planes.slice(at, 20_000))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings in the order of blocks (block, docs, best, plane, bitmap) to each document's sums."""
    number, sums, best = None, np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64)

    def done() -> pa.RecordBatch:
        at = np.flatnonzero(sums)
        out = pa.RecordBatch.from_arrays([pa.array(np.full(len(at), number), pa.int64()), pa.array(at, pa.int32()),
                                          pa.array(best[at]), pa.array(sums[at])], names=["block", "place", "n_best", "count_sum"])
        sums[:], best[:] = 0, 0
        return out

    for batch in batches:
        blocks = batch.column(0).to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            if lo == hi:
                continue
            if number is not None and blocks[lo] != number:
                yield done()
            number = int(blocks[lo])
            docs, top, plane = (batch.column(i).slice(lo, hi - lo).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            maps = batch.column(4).slice(lo, hi - lo)
            offsets = np.frombuffer(maps.buffers()[1], np.int32)[maps.offset:maps.offset + len(maps) + 1].astype(np.int64)
            data = np.frombuffer(maps.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
            places, owner = places_of(data, offsets[1:] - offsets[0])
            times = np.left_shift(1, np.maximum(plane.astype(np.int64) - 1, 0))
            np.add.at(sums, places, (docs * times)[owner])
            np.add.at(best, places, (top * times)[owner])
    if number is not None:
        yield done()


def inverted(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index: rows of documents (pair is null) and of pairs of a block (pair = a * vocabulary of B + b)."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    return written(rows.mapInArrow(_inverted(path_a, path_b), _ROWS), "op12-index")


def pair_counts(index: DataFrame) -> DataFrame:
    """pair, docs (documents that hold it linked), links, of every linked pair."""
    popcount = "case when octet_length(m) = {} then bitmap_count(m) else octet_length(m) div 2 end".format(BLOCK // 8)
    counts = F.expr(f"transform(planes, m -> {popcount})")
    links = F.expr("aggregate(transform(n, (x, i) -> x * shiftleft(1L, greatest(i - 1, 0))), 0L, (s, x) -> s + x)")
    return (index.where("pair is not null").select("pair", counts.alias("n")).select("pair", F.col("n")[0].alias("docs"), links.alias("links"))
            .groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links")))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per input row.

    A document is a row, so repeated rows count each time and get equal
    results. A null or empty text, and one that either tokenizer does not give
    back byte for byte, has no tokens: zeros and an empty groups_sha256. A null
    id keeps its row. Texts of any length are encoded whole; a group of very
    many tokens is counted by its different ids. Of pairs with equal counts
    all are best. Other columns are not read; an empty table gives no row.
    """
    spark = docs.sparkSession
    index = inverted(docs, path_a, path_b, id_col, text_col)
    n_b = _vocabulary(path_b)
    pairs = written(pair_counts(index).select("pair", F.floor(F.col("pair") / n_b).alias("a"), "docs"), "op12-pairs")
    most = pairs.groupBy("a").agg(F.max("docs").alias("most"))
    counts = written(pairs.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).cast("long").alias("best")), "op12-counts")
    postings = index.where("pair is not null").select("block", "pair", "planes").join(counts, "pair")
    postings = postings.select("block", "docs", "best", F.posexplode("planes").alias("plane", "bitmap"))
    size = index.agg(F.count("pair").alias("n")).first()["n"]
    postings = postings.repartition(partitions_for(spark, size, ROWS_EACH), "block").sortWithinPartitions("block")
    sums = postings.mapInArrow(_sums, "block long, place int, n_best long, count_sum long")
    rows = index.where("pair is null").drop("pair", "planes")
    zero = F.lit(0).cast("long")
    return rows.join(sums, ["block", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def _vocabulary(path_b: str) -> int:
    return max(len(PieceTokens(path_b).bytes), 1)
