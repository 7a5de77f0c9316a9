"""Document fingerprints by Order MinHash.

A text's symbols are its runs between spaces; a run of more than `RUN`
characters (a script without spaces, encoded data) counts as its characters,
so an edit stays local. The k-mers of `KMER` symbols are numbered by occurrence
(the second time a k-mer appears it is a different item). Every component of
the signature has a hash of its own over all items, takes the `TUPLE` items
with the smallest values, puts them back in text order and hashes the tuple of
their k-mers. Swapping, inserting or deleting text changes the tuples, so the
share of equal components falls with edit distance.

The hashes are `RINGS` independent ones, each read from `STARTS` equally spaced
points of its ring: h_c(x) = h(x) - c modulo 2**64. So a ring's items are sorted
once, and a component's smallest items are those that follow its point, around
the ring. A component is an Order MinHash component for any number of items;
components of one ring share items when a text has few.

DataFrame functions only: each document is one row's arrays of numbers, sorted
as primitive arrays, so nothing is shuffled for a fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sequence import slice_of
from .common import let, text_or_empty

#: Independent hashes, and components that start at points of each.
RINGS, START_BITS = 4, 4
STARTS = 1 << START_BITS
COMPONENTS = RINGS * STARTS
#: Items in a component's tuple.
TUPLE = 2
#: Symbols in a k-mer.
KMER = 3
#: Characters from which a run between spaces counts as its characters.
RUN = 32

#: Low bits of a packed number that hold a place in the text; the others hold a
#: hash. (Two k-mers of a text that agree in those 36 bits share their numbers.)
_PLACE = 28
_PLACES = (1 << _PLACE) - 1  # no place: marks a component's point


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_PLACES))


def kmer_hashes(text: Column) -> Column:
    """Hashes of the k-mers in text order; a shorter text is one k-mer, an empty one has none."""
    def cut(s: Column) -> Column:
        long = F.exists(s, lambda x: F.char_length(x) > RUN)
        return F.when(long, F.flatten(F.transform(s, lambda x: F.when(F.char_length(x) > RUN, F.split(x, "")).otherwise(F.array(x))))).otherwise(s)

    symbols = F.when(text != "", let(F.split(text, " "), cut)).otherwise(F.array().cast("array<string>"))

    def hashes(s: Column) -> Column:
        whole = F.transform(F.sequence(F.lit(0), F.size(s) - KMER),
                            lambda i: F.xxhash64(*[F.get(s, i + j) for j in range(KMER)]))
        return (F.when(F.size(s) >= KMER, whole)
                .when(F.size(s) > 0, F.array(F.xxhash64(F.array_join(s, " "))))
                .otherwise(F.array().cast("array<bigint>")))

    return let(symbols, hashes)


def _numbered(h: Column) -> Column:
    """Packed (hash of k-mer and occurrence number, place) of every k-mer.

    Sorting (k-mer, place) brings a k-mer's occurrences together in text
    order; the lengths of the runs give the occurrence numbers.
    """
    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                          lambda i: (i == 0) | (F.shiftright(F.get(s, i), _PLACE) != F.shiftright(F.get(s, i - 1), _PLACE)))
        return let(starts, lambda b: items(s, b))

    def items(s: Column, b: Column) -> Column:
        single = F.transform(s, lambda x: item(x, F.lit(1)))
        repeated = F.zip_with(s, occurrences(b, F.size(s)), item)
        return F.when(F.size(b) == F.size(s), single).otherwise(repeated)

    def occurrences(b: Column, n: Column) -> Column:
        return F.flatten(F.transform(b, lambda at, i: F.sequence(F.lit(1), F.coalesce(F.get(b, i + 1), n) - at)))

    def item(x: Column, occurrence: Column) -> Column:
        return F.xxhash64(F.shiftright(x, _PLACE), occurrence).bitwiseAND(F.lit(~_PLACES)).bitwiseOR(_place(x))

    packed = F.transform(h, lambda x, i: F.bitwise_not(F.lit(_PLACES)).bitwiseAND(x).bitwiseOR(i.cast("bigint")))
    return let(F.sort_array(packed), runs)


def _ring(items: Column, ring: int) -> Column:
    """The items (hash, place) by their hash on one ring, and the points of its components."""
    def seeded(x: Column) -> Column:
        h = F.xxhash64(F.shiftright(x, _PLACE), F.lit(ring)) if ring else x
        return h.bitwiseAND(F.lit(~_PLACES)).bitwiseOR(_place(x))

    first = -(1 << 63)
    points = [first + c * (1 << 64 - START_BITS) + _PLACES for c in range(STARTS)]
    return F.sort_array(F.concat(F.transform(items, seeded), F.lit(points).cast("array<bigint>")))


def signature(text: Column) -> Column:
    """Array of `COMPONENTS` longs; null each for a text without items."""
    def components(h: Column) -> Column:
        rings = let(_numbered(h), lambda items: F.concat(*[let(_ring(items, r), lambda q: of_ring(h, q)) for r in range(RINGS)]))
        return F.when(F.size(h) > 0, rings).otherwise(F.array_repeat(F.lit(None).cast("bigint"), COMPONENTS))

    def of_ring(h: Column, q: Column) -> Column:
        places = F.filter(F.transform(q, _place), lambda p: p != _PLACES)
        at = F.filter(F.transform(q, lambda x, i: F.when(_place(x) == _PLACES, i)), lambda i: i.isNotNull())
        before = F.transform(at, lambda i, c: i - c)  # items before a component's point
        return let(places, lambda p: F.transform(before, lambda b: tuple_of(h, p, b)))

    def tuple_of(h: Column, p: Column, b: Column) -> Column:
        n = F.size(p)
        taken = F.transform(F.sequence(F.lit(0), F.least(F.lit(TUPLE), n) - 1), lambda k: F.get(p, (b + k) % n))
        return F.xxhash64(F.transform(F.sort_array(taken), lambda x: F.get(h, x.cast("int"))))

    return let(kmer_hashes(text), components)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal components among those either signature has; two texts
    without items are alike (1)."""
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))

    def share(p: Column) -> Column:
        some = F.size(F.filter(p, lambda x: x["a"].isNotNull() | x["b"].isNotNull()))
        equal = F.size(F.filter(p, lambda x: x["a"] == x["b"]))
        return F.when(some == 0, F.lit(1.0)).otherwise(equal / some)

    return let(pairs, share)


def as_text(sig: Column) -> Column:
    """The signature as hex digits, 16 for each component; '-' where there is none."""
    return F.array_join(F.transform(sig, lambda x: F.coalesce(F.lpad(F.lower(F.hex(x)), 16, "0"), F.lit("-"))), "")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and signature of every row (null text: empty). A text is one row's
    work, however long: its symbols are held as an array, up to 2**28 of them."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), signature(text_or_empty(text_col)).alias("signature"))


# ---------------------------------------------------------------- edited texts

#: Slices of the id order, for each shuffle partition; bytes of text for a slice (their bounds are literals of the plan).
SLICES_EACH = 4
BYTES_EACH = 256 << 20


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, next_text, signature, next_signature: each row with the
    next one in descending id order (after the last: the first).

    The order is cut into slices at approximate quantiles; a slice's last row
    gets the first row of the next slice that has any. Rows with one id are
    ordered by text, a null id comes last.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    slices = max(SLICES_EACH * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BYTES_EACH))
    at = [i / slices for i in range(1, slices)]
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", at, 10 * slices)).first()[0] or []))
    above = len(bounds) - slice_of(F.col("doc_id"), bounds)  # the highest ids are slice 0
    number = F.coalesce(F.when(F.col("doc_id").isNotNull(), above), F.lit(len(bounds)))
    rows = rows.withColumn("slice", number)
    order = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    first = (rows.groupBy("slice").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("low"), "text"))
                                       .alias("first")).select("slice", "first.text"))
    by_slice = Window.orderBy("slice")  # a row a slice
    ring = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = (first.withColumn("sig", signature(F.col("text")))
            .select(F.col("slice").alias("s"),
                    F.coalesce(F.lead("text").over(by_slice), F.first("text").over(ring)).alias("turn_text"),
                    F.coalesce(F.lead("sig").over(by_slice), F.first("sig").over(ring)).alias("turn_sig")))
    inside = Window.partitionBy("slice").orderBy(*order)
    signed = (rows.withColumn("lead_text", F.lead("text").over(inside))
              .withColumn("signature", signature(F.col("text")))
              .withColumn("lead_sig", F.lead("signature").over(inside)))
    return (signed.join(turn, F.col("slice") == F.col("s"))
            .select("doc_id", "text", "signature", F.coalesce("lead_text", "turn_text").alias("next_text"),
                    F.coalesce("lead_sig", "turn_sig").alias("next_signature")))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of every row.

    The edited text is the text whose last floor(n / 2) code points are
    replaced by the first as many (or all) of the next document's. A lone row
    is its own next. Null text: empty. Empty texts are alike (1). An empty
    table gives no rows.
    """
    n = F.char_length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (n - half).cast("int")), F.substring("next_text", F.lit(1), half))
    rows = with_next(docs, id_col, text_col).withColumn("edited", edited)
    rows = rows.withColumn("edited_sig", signature(F.col("edited")))
    return rows.select("doc_id", n.alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       as_text(F.col("signature")).alias("fingerprint"), as_text(F.col("edited_sig")).alias("edited_fingerprint"),
                       likeness(F.col("signature"), F.col("edited_sig")).alias("near_edited"),
                       likeness(F.col("signature"), F.col("next_signature")).alias("near_next"))
