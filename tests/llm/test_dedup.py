"""Suffix-array dedup, SimHash, exact dedup and line dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from helpers import edge_docs, empty_docs, rows
from linestream.llm import exact_dedup, line_dedup, simhash, suffix_dedup
from linestream.llm.suffix_sort import suffix_array


@pytest.mark.parametrize("letters", [1, 2, 3, 20])
def test_suffix_array(letters):
    rng = random.Random(letters)
    for n in [*range(12), 40, 300]:
        for _ in range(30 if n < 50 else 3):
            x = [rng.randint(0, letters - 1) for _ in range(n)]
            assert suffix_array(x) == sorted(range(n), key=lambda i: x[i:])


def brute_spans(texts):
    seen = Counter(t[s:s + 200] for t in texts for s in range(len(t) - 199))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - 199):
            if seen[t[s:s + 200]] > 1:
                gone[s:s + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def edited_copies(seed, n=80):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abc de", k=900)) for _ in range(4)]
    out = []
    for _ in range(n):
        b = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            p = rng.randrange(len(b))
            b[p:p + rng.randint(0, 3)] = rng.choices("xyzé", k=rng.randint(0, 4))
        s = rng.randrange(len(b))
        out.append("".join(b[s:] + b[:s]) if rng.random() < 0.3 else "".join(b[rng.randint(0, 300):rng.randint(400, 900)]))
    return out + ["a" * 1500, "a" * 200, "ab" * 150, "", "q" * 199, "w" * 200, "w" * 200, "z" * 201, "é" * 150]


@pytest.mark.parametrize("options", [{}, {"group_limit": 3}, {"hot_limit": 2}])
def test_suffix_dedup(spark, options, monkeypatch):
    if "hot_limit" in options:
        monkeypatch.setattr(suffix_dedup, "LOCALLY_MANY", 2)
    texts = edited_copies(1)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r[0]: tuple(r)[1:5] for r in suffix_dedup.suffix_dedup(df, **options).collect()}
    assert [got[i] for i in range(len(texts))] == brute_spans([t.encode() for t in texts])


def test_suffix_dedup_units_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "UNIT_BYTES", 2000)
    texts = edited_copies(2, 40)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r[0]: tuple(r)[1:5] for r in suffix_dedup.suffix_dedup(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute_spans([t.encode() for t in texts])


def test_suffix_dedup_awkward_rows(spark):
    df = edge_docs(spark)
    texts = [(r[0], (r[1] or "").encode()) for r in df.select("doc_id", "text").collect()]
    short = [(i, t) for i, t in texts if len(t) < 10_000]
    got = rows(suffix_dedup.suffix_dedup(df.where("doc_id is null or doc_id <> 10")).drop("kept"))
    want = [(i, *x) for (i, _), x in zip(short, brute_spans([t for _, t in short]), strict=True)]
    assert got == sorted(want, key=repr)
    long = suffix_dedup.suffix_dedup(df.where("doc_id = 10")).first()
    assert long["n_removed"] > 0 and long["n_bytes"] == len(dict(texts)[10])


def test_core_places_of_a_long_text_do_not_depend_on_chunks(monkeypatch):
    text = np.frombuffer(np.random.default_rng(1).integers(97, 103, 5000, dtype=np.uint8).tobytes(), np.uint8)
    whole = suffix_dedup.core_places(text)
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 900)
    assert (suffix_dedup.core_places(text) == whole).all()


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, bits=2):
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                up[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def check_components(got, ids, prints, bits=2):
    comp = brute_components(prints, bits)
    low = {}
    for c, i in zip(comp, ids, strict=True):
        low[c] = i if low.get(c) is None else low[c] if i is None else min(low[c], i)
    want = [(i, f"{p:016x}", low[c]) for i, p, c in zip(ids, prints, comp, strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_simhash_awkward_rows(spark):
    df = edge_docs(spark)
    data = df.select("doc_id", "text").collect()
    check_components(simhash.simhash_components(df).collect(), [r[0] for r in data], [brute_fingerprint(r[1]) for r in data])


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
@pytest.mark.parametrize("hot", [simhash.HOT_HOMES, 3])
def test_near_links(spark, bits, hot, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL_GROUP", 5)
    rng = random.Random(bits)
    prints = set()
    for _ in range(25):
        base = rng.getrandbits(64)
        for _ in range(12):
            x = base
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints |= {1 << i for i in range(40)} | {0}
    prints = sorted(prints)
    df = spark.createDataFrame([(simhash._signed(x),) for x in prints], "fp long")
    up = {x: x for x in prints}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in simhash.near_links(df, bits, hot).collect():
        a, b = a % (1 << 64), b % (1 << 64)
        assert (a ^ b).bit_count() <= 2 * bits
        up[root(a)] = root(b)
    want = brute_components(prints, bits)
    assert len({(root(x), c) for x, c in zip(prints, want, strict=True)}) == len(set(want)) == len({root(x) for x in prints})


def test_a_chain_is_one_component(spark):
    chain = [sum(1 << b for b in range(i)) for i in range(0, 64, 2)]
    df = spark.createDataFrame([(simhash._signed(x), i) for i, x in enumerate(chain)], "fp long, low long")
    from linestream.llm.graph import components

    roots = components(simhash.near_links(df)).collect()
    assert len({r["root"] for r in roots}) == 1 and len(roots) == len(chain) - 1


def test_keep_one(spark):
    df = edge_docs(spark)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    got = kept.collect()
    comp = {}
    for r in simhash.simhash_components(df).collect():
        comp.setdefault(r["component_id"], set()).add(r["doc_id"])
    assert len(got) == len(comp)
    assert {r["doc_id"] for r in got} == set(comp)
    assert simhash.keep_one(empty_docs(spark)).count() == 0


def test_cuckoo_index_inserts_deletes_and_resizes():
    index, rng = exact_dedup.CuckooIndex(1), random.Random(3)
    live = {}
    for _ in range(6000):
        key = rng.randrange(900)
        digest = (key * 0x9E3779B97F4A7C15) & exact_dedup._MASK
        slot = index.find(digest, key)
        assert (slot is not None) == (key in live)
        if slot is None:
            live[key] = rng.random()
            index.insert(digest, key, live[key])
        else:
            assert index.payload(slot) == live.pop(key)
            index.delete(slot)
    assert {r[1]: r[2] for r in index.live()} == live and index.resizes > 3


def test_cuckoo_hit_is_checked_against_the_content():
    index = exact_dedup.CuckooIndex()
    index.insert(5, "a", 1)
    assert index.find(5, "b") is None
    index.insert(5, "b", 2)
    assert index.payload(index.find(5, "a")) == 1 and index.payload(index.find(5, "b")) == 2


@pytest.mark.parametrize("digits", [0, 1, 64])
def test_copies_are_compared_byte_by_byte(spark, digits):
    """A weak stored key gives many clashes and the same result."""
    from pyspark.sql import functions as F

    df = edge_docs(spark).unionByName(edge_docs(spark).withColumn("doc_id", F.col("doc_id") + 50))
    weak = exact_dedup.exact_dedup(df, key_of=lambda t: F.substring(F.sha2(t, 256), 1, digits))
    assert rows(weak) == rows(exact_dedup.exact_dedup(df))


def test_line_dedup_keeps_all_columns_and_one_copy(spark):
    df = edge_docs(spark)
    out = line_dedup.line_dedup(df)
    assert out.columns == [*df.columns, "_n_lines", "_n_removed"]
    got = {r["doc_id"]: r for r in out.where("doc_id in (8, 9)").collect()}
    before = {r["doc_id"]: r["text"] for r in df.where("doc_id in (8, 9)").collect()}
    assert got[8]["text"] == before[8] and got[8]["_n_removed"] == 0
    assert got[9]["_n_removed"] >= 2 and len(got[9]["text"].split("\n")) == len(before[9].split("\n")) - got[9]["_n_removed"]
    assert line_dedup.line_dedup(empty_docs(spark)).count() == 0


def test_chunks_are_cut_alike_wherever_they_stand(spark, monkeypatch):
    """With a divisor above one: where a chunk begins follows from its own lines."""
    monkeypatch.setattr(line_dedup, "DIVISOR", 3)
    lines = [f"line {i * 7919 % 1000}" for i in range(400)]
    texts = ["\n".join(lines), "\n".join(["x"] + lines), "\n".join(["x", "y", "z"] + lines[:200] + ["new"] + lines[200:])]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [{(c["a"], c["b"]) for c in r[0]} for r in df.select(line_dedup.chunk_keys(F.col("t"))).collect()]
    assert 80 < len(found[0]) < 190
    assert found[0] <= found[1] and len(found[0] - found[2]) <= 1


def test_repeated_passages_are_found(spark):
    """Recall by lines against brute force: lines of passages (two lines or more) met in an earlier,
    different document; texts that are whole copies are left out."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows, seen = [], set()
    for r in docs.orderBy("doc_id").collect():
        if r["text"] not in seen:
            seen.add(r["text"])
            rows.append((r["doc_id"], r["text"]))
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    pairs, met, left = set(), 0, 0
    for doc_id, text in rows:
        lines = text.split("\n")
        own = [(a, b) for a, b in zip(lines, lines[1:])]
        repeated = {k for i, p in enumerate(own) if p in pairs for k in (i, i + 1)}
        kept = Counter(got[doc_id].split("\n"))
        met += len(repeated)
        left += sum(min(kept[line], n) for line, n in Counter(lines[k] for k in repeated).items())
        pairs.update(own)
    assert met > 100 and 1 - left / met >= 0.9


def test_a_run_of_one_line_keeps_its_first_two(spark):
    df = spark.createDataFrame([(1, "a\n" + "same\n" * 90 + "b"), (2, "same\nsame\nc"), (3, "c\nd")], "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["_n_removed"]) for r in line_dedup.line_dedup(df).collect()}
    assert got == {1: ("a\nsame\nsame\nb", 88), 2: ("c", 2), 3: ("c\nd", 0)}


def test_texts_without_repeated_chunks_are_not_moved_for_comparison(spark, monkeypatch):
    wanted = spark.createDataFrame([(i, 7 * i) for i in range(0, 4000, 20)] + [(None, 5), (3, None)], "doc_id long, text_key long")
    rows = spark.createDataFrame([(i, 7 * i, "x") for i in range(4000)] + [(None, 5, "y"), (3, None, "z")], "doc_id long, text_key long, text string")
    for pieces in (4096, 1):  # the bitmap at its full size, and one that is too small for its rows
        monkeypatch.setattr(line_dedup, "FILTER_PIECES", pieces)
        monkeypatch.setattr(line_dedup, "FILTER_BITS", 16 if pieces > 1 else 10**6)
        out = line_dedup.maybe_in(rows, wanted, ["doc_id", "text_key"])
        got = {(r["doc_id"], r["text_key"]) for r in out.collect()}
        assert out.columns == rows.columns and {tuple(r) for r in wanted.collect()} <= got
        assert len(got) < 400
    assert line_dedup.maybe_in(rows, wanted.where("1 = 0"), ["doc_id", "text_key"]).count() == 0
