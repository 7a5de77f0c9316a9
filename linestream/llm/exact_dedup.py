"""Exact dedup with a cuckoo-filter index of live digests.

Every text is reduced to a 64-bit digest; the index holds the digests of the
rows that currently stay ("live"). A row whose digest is not in the filter is
inserted. On a filter hit the record stored beside the matching slot (SHA-256
and byte length of the whole text) is compared, so neither a 16-bit fingerprint
clash nor a digest clash merges two texts; then the bytes of every copy are
compared with those of the row that stays, bucketed by key. A verified hit with
a larger id deletes the live entry and inserts the new one. When an insertion
cannot be placed, the table doubles and is rebuilt from its stored keys.

On Spark: rows are reduced per (content, salt) before the shuffle, so a text
that a third of all rows share reaches its index partition as at most `SALTS`
rows; partitions are dealt by content and sized by row count, each holds its
own filter. The result goes back to the rows through a shuffle join whose hot
partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions_for, text_or_empty, written

#: Partial groups one text may send to its index partition.
SALTS = 16
#: Distinct texts an index partition is sized for (about 150 bytes each).
KEYS_PER_PARTITION = 500_000

_MASK = (1 << 64) - 1


class CuckooIndex:
    """Cuckoo filter (16-bit fingerprints, 4 slots a bucket) whose slots also
    name the stored key and content record, for checking and for resizing."""

    SLOTS = 4
    MAX_KICKS = 200

    def __init__(self, buckets: int = 64):
        self.records: list = []  # record number -> (digest, content, payload) or None
        self.size = 0
        self.resizes = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = [0] * (buckets * self.SLOTS)
        self.where = [-1] * (buckets * self.SLOTS)

    @staticmethod
    def _print(digest: int) -> int:
        return (digest & 0xFFFF) or 1

    def _first(self, digest: int) -> int:
        return (digest >> 16) & self.mask

    def _other(self, bucket: int, fp: int) -> int:
        return (bucket ^ (fp * 0x9E3779B97F4A7C15 >> 20)) & self.mask

    def _slots(self, digest: int) -> Iterator[int]:
        fp, a = self._print(digest), self._first(digest)
        b = self._other(a, fp)
        for bucket in (a, b) if a != b else (a,):
            for s in range(bucket * self.SLOTS, (bucket + 1) * self.SLOTS):
                if self.prints[s] == fp:
                    yield s

    def find(self, digest: int, content) -> int | None:
        """Slot of the live entry with this very content; None if there is none."""
        for s in self._slots(digest):
            rec = self.records[self.where[s]]
            if rec[0] == digest and rec[1] == content:
                return s
        return None

    def payload(self, slot: int):
        return self.records[self.where[slot]][2]

    def delete(self, slot: int) -> None:
        self.records[self.where[slot]] = None
        self.prints[slot], self.where[slot] = 0, -1
        self.size -= 1

    def insert(self, digest: int, content, payload) -> None:
        self.records.append((digest, content, payload))
        self.size += 1
        if len(self.records) > 64 and len(self.records) > 2 * self.size:
            self._rebuild(self.mask + 1)  # drop the records of deleted entries
        elif self.size > 0.9 * len(self.prints) or not self._place(digest, len(self.records) - 1):
            self._rebuild(2 * (self.mask + 1))

    def _place(self, digest: int, number: int) -> bool:
        fp, bucket = self._print(digest), self._first(digest)
        for kick in range(self.MAX_KICKS):
            for b in (bucket, self._other(bucket, fp)):
                for s in range(b * self.SLOTS, (b + 1) * self.SLOTS):
                    if self.where[s] < 0:
                        self.prints[s], self.where[s] = fp, number
                        return True
            bucket = self._other(bucket, fp)
            s = bucket * self.SLOTS + kick % self.SLOTS
            self.prints[s], fp = fp, self.prints[s]
            self.where[s], number = number, self.where[s]
        return False

    def _rebuild(self, buckets: int) -> None:
        """Resize from the stored keys. Many equal digests with different
        content need room too, so the table grows until all fit."""
        self.records = [r for r in self.records if r is not None]
        self.resizes += 1
        while True:
            self._clear(buckets)
            if all(self._place(r[0], i) for i, r in enumerate(self.records)):
                return
            if buckets > 64 * (len(self.records) + 64):  # only identical digests can overflow so empty a table
                raise OverflowError("more than eight different texts share one 64-bit digest")
            buckets *= 2

    def live(self) -> Iterator[tuple]:
        return (r for r in self.records if r is not None)


_INDEX_SCHEMA = "key string, n_bytes long, keep_id long, group_size long"


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


def _index_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(5)]
        for digest, sha, n_bytes, doc_id, n in zip(*cols, strict=True):
            key, content = digest & _MASK, (sha, n_bytes)
            slot = index.find(key, content)
            if slot is None:
                index.insert(key, content, (doc_id, n))
                continue
            keep, size = index.payload(slot)
            best = doc_id if keep is None or (doc_id is not None and doc_id > keep) else keep
            index.delete(slot)
            index.insert(key, content, (best, size + n))
    out: list[list] = [[], [], [], []]

    def flush() -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)],
                                          names=["key", "n_bytes", "keep_id", "group_size"])

    for _, (sha, n_bytes), (keep, size) in index.live():
        for c, v in zip(out, (sha, n_bytes, keep, size), strict=True):
            c.append(v)
        if len(out[0]) >= 20_000:
            yield flush()
            out = [[], [], [], []]
    if out[0]:
        yield flush()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_of=_sha) -> DataFrame:
    """One row per input row: `id_col`, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after no change; of equal texts the row
    with the largest id stays. Null text counts as empty (and equals it). A
    null id sorts below every other; if a group has only null ids, keep_id is
    null and one row stays. Of repeated rows (same id, same text) exactly one
    is kept. Other columns of the input are not read. `key_of` makes the stored
    key of a text; a weak one costs time, not correctness.
    """
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), key_of(text).alias("key"), _sha(text).alias("sha"),
                       F.xxhash64(key_of(text), F.octet_length(text)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"),
                       text.alias("text"))
    members = written(rows.groupBy("id", "key", "sha", "digest", "n_bytes").agg(F.count(F.lit(1)).alias("n")), "op4-members")
    partial = (members.groupBy("key", "digest", "n_bytes", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
               .agg(F.max("id").alias("id"), F.sum("n").alias("n"))
               .select("digest", "key", "n_bytes", "id", "n"))
    parts = partitions_for(spark, members.count(), KEYS_PER_PARTITION)
    index = written(partial.repartition(parts, "digest").mapInArrow(_index_partition, _INDEX_SCHEMA), "op4-index")
    index = index.select(F.col("key").alias("i_key"), F.col("n_bytes").alias("i_bytes"), "keep_id", "group_size")
    same = (F.col("key") == F.col("i_key")) & (F.col("n_bytes") == F.col("i_bytes"))
    found = members.join(index, same).select("id", "key", "n_bytes", "sha", "n", "keep_id", "group_size")

    # the bytes of every copy against those of the row that stays
    copies = written(rows.join(index.where("group_size > 1"), same)
                     .select("key", "n_bytes", "id", "sha", "text", F.col("id").eqNullSafe(F.col("keep_id")).alias("stays")), "op4-copies")
    stays = written(copies.where("stays").groupBy(F.col("key").alias("s_key"), F.col("n_bytes").alias("s_bytes"))
                    .agg(F.any_value("text").alias("s_text")), "op4-stays")
    # both written: a grouping right before or behind the join would keep AQE from splitting a large group
    differ = written(copies.join(stays, (F.col("key") == F.col("s_key")) & (F.col("n_bytes") == F.col("s_bytes")))
                     .where(F.col("text") != F.col("s_text")).select("key", "n_bytes"), "op4-differ")
    if differ.take(1):  # one key, several texts: these groups go by the text itself
        differ = differ.distinct()
        own = copies.join(differ, ["key", "n_bytes"])
        groups = (own.groupBy("text").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                  .withColumnRenamed("text", "g_text"))
        again = (own.groupBy("id", "key", "n_bytes", "sha", "text").agg(F.count(F.lit(1)).alias("n"))
                 .join(groups, F.col("text") == F.col("g_text")).drop("text", "g_text"))
        found = found.join(differ, ["key", "n_bytes"], "left_anti").unionByName(again)
    copy = F.posexplode(F.sequence(F.lit(1), F.col("n")))
    return (found.select("id", "keep_id", "group_size", "sha", copy.alias("copy", "_c"))
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"),
                    F.col("sha").alias("text_sha256")))
