"""Line dedup by content-defined chunks of lines.

A document is split at newlines. A rolling hash over the hashes of two lines
decides whether a chunk begins at the first of them (where it is divisible by
`DIVISOR`); the chunk is those two lines. Where a chunk begins depends on its
own lines alone, so the same run of lines is cut alike wherever it stands. At
the default divisor of one every line begins a chunk: repeated passages are
short (two lines for most), and any pair of lines that occurs twice is found;
a longer passage is the union of its overlapping chunks.

Chunks that occur more than once in the whole table are looked up by 128 bits
of hashes, compared byte by byte with the first occurrence (smallest id, then
text key, then place), and removed everywhere else. A run of one repeated line
keeps its first two lines.

DataFrame functions only. Counting moves hashes and places, reduced per task.
Whole texts are moved once, to get their lines removed; before that, only those
that a broadcast bitmap says may have a repeated chunk. AQE splits the partition
of a chunk that very many documents share.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, text_or_empty, written

#: A chunk begins where the rolling hash is divisible by this; more than one trades recall for work.
DIVISOR = 1
#: Lines of a chunk.
LINES = 2
#: Bits of a bitmap of Spark's bitmap functions (as a power of two).
PIECE = 15
#: Bits for each row that a filter stands for, and the most bitmaps it has (16 MB):
#: with more rows it lets more of the others pass.
FILTER_BITS, FILTER_PIECES = 16, 4096


def number_of(text: Column, digits: int) -> Column:
    """The first hex digits of the MD5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def chunk_keys(text: Column) -> Column:
    """Array of (no, a, b): the first line's number and two hashes of every chunk of a text."""
    def rolled(h: Column) -> Column:
        # the rolled hash of both lines, and the first line's own beside it
        whole = F.transform(F.sequence(F.lit(0), F.size(h) - LINES), lambda i: F.struct(
            i.alias("no"), F.xxhash64(*[F.get(h, i + k) for k in range(LINES)]).alias("a"), F.get(h, i).alias("b")))
        return whole if DIVISOR == 1 else F.filter(whole, lambda c: F.pmod(c["a"], F.lit(DIVISOR)) == 0)

    none = F.array().cast("array<struct<no:int,a:bigint,b:bigint>>")
    return let(F.transform(lines_of(text), lambda x: F.xxhash64(x)), lambda h: F.when(F.size(h) >= LINES, rolled(h)).otherwise(none))


def chunk_text(lines: Column, no: Column) -> Column:
    return F.array_join(F.slice(lines, no + 1, F.lit(LINES)), "\n")


def maybe_in(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose keys are in `wanted` (null like any value), and few others: those whose
    hash has its bit set in a broadcast bitmap. For a join to come, which moves fewer rows then."""
    pieces = min(max(1, math.ceil(wanted.count() * FILTER_BITS / 2**PIECE)), FILTER_PIECES)
    at = F.pmod(F.xxhash64(*keys), F.lit(pieces * 2**PIECE))
    piece, bit = F.shiftright(at, PIECE), at.bitwiseAND(F.lit(2**PIECE - 1))
    bits = wanted.groupBy(piece.alias("_piece")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    own = rows.withColumns({"_of": piece, "_bit": bit}).join(F.broadcast(bits), F.col("_of") == F.col("_piece"))
    byte = F.substring(F.col("_bits"), F.shiftright("_bit", 3).cast("int") + 1, F.lit(1))
    return own.where(F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), F.col("_bit") % 8) == 1).select(*rows.columns)


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, gone: the lines (from 0, rising) to remove from each document
    that has any (documents are named by id and text key)."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    keyed = rows.select("doc_id", number_of(F.col("text"), 15).alias("text_key"), F.inline(chunk_keys(F.col("text"))))
    place = F.struct("doc_id", "text_key", "no")
    repeated = written(keyed.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
                       .where("n > 1").select(F.col("a").alias("ka"), F.col("b").alias("kb"), "first"), "line-repeated")
    # repeated chunks by document: hashes and places only; equal rows are one document
    found = keyed.join(repeated, (F.col("a") == F.col("ka")) & (F.col("b") == F.col("kb")))
    chunks = written(found.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("no", "a", "b", "first")).alias("chunks")),
                     "line-chunks")
    own = chunks.select(F.col("doc_id").alias("id"), F.col("text_key").alias("tk"), "chunks")
    texts = maybe_in(rows.select("doc_id", number_of(F.col("text"), 15).alias("text_key"), "text"), chunks, ["doc_id", "text_key"])
    # a text is cut into lines once, whatever the number of its chunks
    with_text = let(lines_of(F.col("text")), lambda lines: F.transform("chunks", lambda c: F.struct(
        c["no"].alias("no"), c["a"].alias("a"), c["b"].alias("b"), c["first"].alias("first"), chunk_text(lines, c["no"]).alias("chunk"))))
    members = (texts.join(own, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("tk")))
               .select("doc_id", "text_key", F.inline(with_text)))
    members = written(members.withColumn("is_first", place.eqNullSafe(F.col("first"))), "line-members")
    firsts = (members.where("is_first").groupBy(F.col("a").alias("ka"), F.col("b").alias("kb"))
              .agg(F.any_value("chunk").alias("first_chunk")))
    same = (F.col("a") == F.col("ka")) & (F.col("b") == F.col("kb")) & (F.col("chunk") == F.col("first_chunk"))
    # the line that a chunk shares with the first occurrence itself stays
    beside = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    kept = F.when(beside & (F.col("no") < F.col("first.no") + LINES), F.col("first.no") + LINES - F.col("no")).otherwise(0)
    gone = F.explode(F.sequence(F.col("no") + kept, F.col("no") + LINES - 1))
    return (members.where("not is_first").join(firsts, same).select("doc_id", "text_key", gone.alias("line"))
            .groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("line")).alias("gone")))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's columns with the text cleaned, and `_n_lines`, `_n_removed`.

    Null text stays null with no lines; an empty text has one empty line. A
    document may end up empty. Rows with the same id and the same text are
    judged as one document and get the same result. A null id sorts first. An
    empty table gives no rows. All columns are kept, whatever their names.
    Texts are read whole: a document's lines are one row's array, and the lines to
    remove are turned into flags beside it, so the work is linear in its length.
    """
    gone = removals(docs, id_col, text_col).select(F.col("doc_id").alias("g_id"), F.col("text_key").alias("g_key"), "gone")
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"),
                       number_of(text_or_empty(text_col), 15).alias("key"))
    # the text is moved inside its row alone
    joined = (rows.join(gone, F.col("id").eqNullSafe(F.col("g_id")) & (F.col("key") == F.col("g_key")), "left")
              .withColumn("t", F.col("row")[text_col].cast("string")))
    # lines and flags are bound once, not evaluated for each line
    clean = let(lines_of(F.col("t")), lambda lines: let(_flags(F.col("gone"), F.size(lines)), lambda flags: F.array_join(
        F.filter(lines, lambda _, i: F.get(flags, i) == 0), "\n")))
    done = joined.withColumn("clean", F.when(F.col("gone").isNotNull(), clean))
    columns = [F.coalesce("clean", "t").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    breaks = F.octet_length("t") - F.octet_length(F.replace(F.col("t"), F.lit("\n"), F.lit("")))
    lines = F.when(F.col("t").isNull(), 0).otherwise(breaks + 1)
    return done.select(*columns, lines.alias("_n_lines"), F.when(F.col("gone").isNotNull(), F.size("gone")).otherwise(0).alias("_n_removed"))


def _flags(gone: Column, n: Column) -> Column:
    """An array of n zeros with ones at the places in `gone` (rising): the stretches between them, joined."""
    zeros = F.transform(gone, lambda g, i: F.concat(
        F.array_repeat(F.lit(0), g - F.coalesce(F.get(gone, i - 1), F.lit(-1)) - 1), F.array(F.lit(1))))
    return F.concat(F.flatten(zeros), F.array_repeat(F.lit(0), n - 1 - F.coalesce(F.element_at(gone, -1), F.lit(-1))))
