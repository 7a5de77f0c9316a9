"""Extraction, packing, fingerprints, scoring, language ID and mixing."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from helpers import CLASHES, ROWS, edge_docs, empty_docs
from linestream.llm import html_extract, katz, language_id, mixing, order_minhash, packing

SF = "/root/testdata/sf0.01"
TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"

# ---------------------------------------------------------------- HTML

PAGE = """<!DOCTYPE html><html><head><title>A title</title><style>p{}</style><script>var x="</p><p>no";</script></head>
<body class="sidebar-off"><nav><ul><li><a href="/">Home</a></li><li><a href="/b">The news of the day and all that is in it</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site and you have to accept all of them if you want to go on with it.</div>
<div class="ad">Buy now.</div><main><h1>The   head &amp; line</h1><p>This is the first paragraph of the article, and it is long
 enough that it has many of the stop words that are in the language.<p>Short one.<br>Next
line.</p><!-- a <p>comment</p> --><blockquote>He said &quot;no&quot; &#8211; &eacute;</blockquote>
<aside>This is an aside of the page and it has a lot of words that are in the language of the page as well.</aside>
<form><label>Name of the reader</label><input value="x > y"><button>Send</button></form></main>
<div id="comments"><p>I am a reader and this is what I have to say about the article that was in the paper today.</p></div>
<footer>&copy; 2024 Company</footer></body></html>"""


def test_html_blocks():
    assert html_extract.main_text(PAGE) == (
        "The head & line This is the first paragraph of the article, and it is long enough that it has many of the stop "
        "words that are in the language. Short one. Next line. He said \"no\" – é")


def test_html_without_structure():
    long = "This is a paragraph that is long enough and it has many of the words that are common in the language of it."
    bad = "Alpha Beta Gamma Delta Epsilon Zeta Eta Theta Iota Kappa Lambda Omikron Sigma Upsilon Omega Aleph Beth"
    links = "".join(f"<li><a href=x>Link number {i} to a page</a></li>" for i in range(9))
    page = f"<ul>{links}</ul><div>Menu</div><h1>Head</h1><p>{long}</p><p>Short.</p><p>{long}</p><p>{bad}</p><p>Top</p>"
    assert html_extract.main_text(page) == f"Head {long} Short. {long}"


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain", "plain"), ("<p>a", "a"), ("a < b & c", "a < b & c"), ("<script>x", ""),
    ("<!-- never closed", ""), ("<p>one</p><p>two", "one two"), ("&lt;p&gt;", "<p>"), ("<a href='", "<a href='"),
])
def test_html_small(html, text):
    assert html_extract.main_text(html) == text


def test_html_is_linear_on_hostile_pages():
    for page in ("<" * 200_000, "<a " * 60_000, "<a href=\"" * 40_000, "<!--" * 60_000, "<div>" * 50_000, "<p>a" * 50_000):
        html_extract.main_text(page)


def test_html_query(spark):
    cols = ["page_id", "url", "html", "text", "n_chars"]
    df = spark.createDataFrame([(1, "u", PAGE, "x", 1), (1, "u", PAGE, "x", 1), (None, None, None, None, None), (2, "v", "", "", 0)],
                               "page_id long, url string, html string, text string, n_chars long")
    out = html_extract.extract(df)
    got = out.collect()
    assert out.columns == ["page_id", "url", "text", "n_chars"] and df.columns == cols
    assert Counter(r["page_id"] for r in got) == {1: 2, 2: 1, None: 1}
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_extract.extract(df.where("1 = 0")).count() == 0


# ---------------------------------------------------------------- packing


def token_ids(text):
    from tokenizers import Tokenizer

    return np.array(Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


def check_packing(pieces, capacity):
    by = defaultdict(list)
    for r in pieces:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_awkward_rows(spark):
    docs = edge_docs(spark)
    got = packing.best_fit_packing(docs, TOKENIZER, 64).collect()
    check_packing(got, 64)
    want = Counter()
    for r in ROWS:
        ids = token_ids(r[1])
        for piece, at in enumerate(range(0, len(ids), 64)):
            part = ids[at:at + 64]
            want[r[0], piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert packing.best_fit_packing(empty_docs(spark), TOKENIZER).count() == 0


def test_packing_round_trip_and_size(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = packing.best_fit_packing(docs, TOKENIZER).collect()
    assert check_packing(got, 2048) <= math.ceil(sum(r["length"] for r in got) / 2048) * 1.01
    ids = {r["doc_id"]: token_ids(r["text"]) for r in docs.where("doc_id % 25 = 0").collect()}
    for r in got:
        if r["doc_id"] in ids:
            assert zlib.crc32(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]


def test_words_are_encoded_as_the_whole_text(monkeypatch):
    encoder = packing.WordIds(TOKENIZER)
    monkeypatch.setattr(packing, "WORD_CACHE", 5)
    for text in ["<|startoftext|> The <|STARTOFTEXT|>", "a.b, c., 'S it's ... ΣΑΣ. İ., é. é. x y\tz ", "", " ", "a\n\nb.,.",
                 "１２ ３. ﬁ.", "The CAT, the cat. THE", "日本語。 テキスト"]:
        assert encoder.of(text) == token_ids(text).tobytes(), text


def test_words_kept_are_bounded_in_bytes(monkeypatch):
    """Texts without spaces are one word each: the words kept are bounded by their bytes, not by their number alone."""
    monkeypatch.setattr(packing, "CACHE_BYTES", 20_000)
    encoder = packing.WordIds(TOKENIZER)
    for i in range(60):
        text = f"{i}語の文章は空白がない。" * 40
        assert encoder.of(text) == token_ids(text).tobytes()
        kept = sum(len(w) + len(ids) for g in (encoder.new, encoder.old) for w, ids in g.items())
        assert kept < 2 * (20_000 + 10_000)
    assert encoder.of("the cat. " * 9) == token_ids("the cat. " * 9).tobytes()


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_up_any_histogram(seed):
    rng = np.random.default_rng(seed)
    hist = np.zeros(101, np.int64)
    hist[1:] = rng.integers(0, [3, 50, 1000, 5][seed], 100) * (rng.random(100) < [0.2, 0.9, 0.5, 0.02][seed])
    plan = packing.make_plan(hist, 100)
    used = np.zeros(101, np.int64)
    for lengths, n in plan:
        assert sum(lengths) <= 100 and n > 0
        for x in lengths:
            used[x] += n
    assert (used == hist).all()


def test_patterns_carry_most_of_a_large_histogram():
    rng = np.random.default_rng(0)
    hist = np.bincount(rng.integers(1, 101, 200_000), minlength=101)
    left = hist.copy()
    patterns = packing.list_patterns(left, 100)
    x = packing.fit_repeats(patterns, left)
    gap = hist.astype(float)
    for k, p in zip(x, patterns, strict=True):
        for length in p:
            gap[length] -= k
    assert (x >= 0).all() and np.abs(gap[:100]).sum() < 0.25 * hist[:100].sum()
    total = (np.arange(101) * hist).sum()
    assert sum(n for _, n in packing.make_plan(hist, 100)) <= 1.01 * math.ceil(total / 100)


# ---------------------------------------------------------------- Order MinHash

M = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def spark_hash(*values):
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else int(v[0]).to_bytes(v[1], "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return signed(seed)


def kmers_of(text):
    o = order_minhash
    symbols = []
    for s in text.split(" ") if text else []:
        symbols += list(s) if len(s) > o.RUN else [s]
    n = len(symbols) - o.KMER + 1
    return [symbols[i:i + o.KMER] for i in range(n)] if n > 0 else [symbols] if symbols else []


def brute_signature(text):
    """Every component by its definition: its own hash of every item, the smallest ones in text order."""
    o = order_minhash
    h = [spark_hash(*k) if len(k) == o.KMER else spark_hash(" ".join(k)) for k in kmers_of(text)]
    if not h:
        return [None] * o.COMPONENTS
    seen, items = Counter(), []
    for at, x in enumerate(h):
        kmer = x >> o._PLACE
        seen[kmer] += 1
        items.append((spark_hash((kmer, 8), (seen[kmer], 4)), at))
    out = []
    for ring in range(o.RINGS):
        hashed = [(spark_hash((x >> o._PLACE, 8), (ring, 4)) if ring else x, at) for x, at in items]
        packed = [(x & ~o._PLACES | at, at) for x, at in hashed]
        for c in range(o.STARTS):
            point = -(1 << 63) + (c << (64 - o.START_BITS)) + o._PLACES
            least = sorted(((x - point) % (1 << 64), at) for x, at in packed)[:o.TUPLE]
            out.append(spark_hash(*[(h[at], 8) for at in sorted(at for _, at in least)]))
    return out


def plain_order_minhash(text, components=64):
    """An Order MinHash of another make: independent hashes of occurrence-numbered k-mers."""
    seen, items = Counter(), []
    for k in map(tuple, kmers_of(text)):
        seen[k] += 1
        items.append(repr((k, seen[k])).encode())
    out = []
    for c in range(components):
        least = sorted((xxhash.xxh64_intdigest(x, c), at) for at, x in enumerate(items))[:2]
        out.append(tuple(items[at].rsplit(b", ", 1)[0] for at in sorted(at for _, at in least)))
    return out


TEXTS = ["", "a", "a b", "a b c", "the the the the the the", " ".join(f"w{i % 7}" for i in range(60)),
         " ".join(f"w{i}" for i in range(400)), "x" * 500, "a  b\n c", "é" * 40 + " ü", LONG := "the of and a " * 300]


def test_order_minhash_against_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: r["signature"] for r in order_minhash.fingerprints(df).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == brute_signature(t), t[:30]


def test_order_minhash_feels_order(spark):
    words = [f"w{i}" for i in range(600)]
    texts = [" ".join(words), " ".join(words[:300] + ["new"] + words[301:]), " ".join(words[300:] + words[:300]),
             " ".join(w for i in range(0, 600, 6) for w in reversed(words[i:i + 6])), " ".join(f"v{i}" for i in range(600))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    s = {r[0]: r[1] for r in order_minhash.fingerprints(df).collect()}
    like = [sum(a == b for a, b in zip(s[0], s[i], strict=True)) / len(s[0]) for i in range(5)]
    assert like[0] == 1 and like[1] > 0.9 > like[2] > 0.3 > like[4] == 0 and like[3] < 0.2


@pytest.mark.parametrize("n", [10, 20, 40, 80, 160, 640])
def test_order_minhash_sees_order_at_any_length(spark, n):
    """Texts against themselves with their halves swapped: as an independent Order MinHash has it, on average."""
    rng = np.random.default_rng(n)
    pairs = []
    for _ in range(40 if n < 200 else 8):
        words = [f"w{i}" for i in rng.permutation(10 * n)[:n]]
        pairs.append((" ".join(words), " ".join(words[n // 2:] + words[:n // 2])))
    df = spark.createDataFrame([(i, t) for i, p in enumerate(pairs) for t in p], "doc_id long, text string").coalesce(4)
    got = df.select("doc_id", order_minhash.signature(F.col("text")).alias("signature")).groupBy("doc_id").agg(
        F.collect_list("signature").alias("s")).select(order_minhash.likeness(F.col("s")[0], F.col("s")[1]).alias("x")).collect()
    want = [np.mean([x == y for x, y in zip(*map(plain_order_minhash, p), strict=True)]) for p in pairs]
    assert abs(np.mean([r["x"] for r in got]) - np.mean(want)) < 0.1
    assert np.mean([r["x"] for r in got]) < 0.6


def test_an_edit_in_a_long_run_stays_local(spark):
    rng = np.random.default_rng(1)
    run = "".join(chr(0x4e00 + i) for i in rng.integers(0, 3000, 900))
    df = spark.createDataFrame([(1, run), (2, run[:300] + "X" + run[300:])], "doc_id long, text string")
    s = {r[0]: r[1] for r in order_minhash.fingerprints(df).collect()}
    assert sum(x == y for x, y in zip(s[1], s[2], strict=True)) / len(s[1]) > 0.9


def edits(pairs):
    order = sorted(pairs, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    for k, (i, text) in enumerate(order):
        half = len(text) // 2
        nxt = order[(k + 1) % len(order)][1]
        yield i, text, text[:len(text) - half] + nxt[:half], nxt


@pytest.mark.parametrize("slices", [4, 40])
def test_edited_texts(spark, slices, monkeypatch):
    monkeypatch.setattr(order_minhash, "SLICES_EACH", slices)
    df = edge_docs(spark)
    pairs = [(r[0], r[1] or "") for r in ROWS]
    want = Counter()
    for i, text, edited, nxt in edits(pairs):
        a, b, c = map(brute_signature, (text, edited, nxt))

        def like(x, y):
            some = [(p, q) for p, q in zip(x, y, strict=True) if p is not None or q is not None]
            return round(sum(p == q for p, q in some) / len(some), 9) if some else 1.0

        want[i, len(text), hashlib.sha256(edited.encode()).hexdigest(), like(a, b), like(a, c)] += 1
    got = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9))
                  for r in order_minhash.edited_likeness(df).collect())
    assert got == want
    assert order_minhash.edited_likeness(empty_docs(spark)).count() == 0


# ---------------------------------------------------------------- Katz backoff


def brute_katz(train, texts):
    def tokens(t):
        return [*(t or "").encode().lower().split(), "end"]

    c, pairs = Counter(), defaultdict(Counter)
    for t in train:
        w = tokens(t)
        c.update(w)
        for v, x in zip(["start", *w], w, strict=False):
            pairs[v][x] += 1
    total, kinds = sum(c.values()), len(c)

    def counts_of_counts(values):
        n = Counter(values)
        return katz.discounts({f"n{r}": n[r] for r in range(1, katz.K + 2)})

    d1 = counts_of_counts(c.values())
    d2 = counts_of_counts(x for ws in pairs.values() for x in ws.values())

    def f(d, r):
        return d[r] if r <= katz.K else 1.0

    p1 = {w: f(d1, n) * n / total for w, n in c.items()}
    unknown = 1 - sum(p1.values())

    def prob(x, v):
        ws = pairs.get(v, {})
        n, kept = sum(ws.values()), sum(f(d2, r) * r for r in ws.values())
        norm = (1 / n if kept < n * (1 - 1e-12) else 1 / (n + 1)) if n else 0
        if x in ws:
            return f(d2, ws[x]) * ws[x] * norm
        return (1 - kept * norm) / (1 - sum(p1[y] for y in ws)) * p1.get(x, unknown)

    for v in ["start", *list(c)[:40], b"never met"]:
        assert abs(sum(prob(x, v) for x in c) + prob(b"never met", v) - 1) < 1e-9
    for t in texts:
        w = tokens(t)
        yield (len(w), sum(c[x] > 0 for x in w), total,
               sum(math.log10((c[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w),
               sum(math.log10(prob(x, v)) for v, x in zip(["start", *w], w, strict=False)))


@pytest.mark.parametrize("many", [katz.TOKENS_AT_ONCE, 50])
def test_katz_against_brute_force(spark, many, monkeypatch):
    monkeypatch.setattr(katz, "TOKENS_AT_ONCE", many)
    df = edge_docs(spark)
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 1 for r in ROWS]
    want = sorted(((r[0], h, *x) for r, h, x in zip(ROWS, held, brute_katz(
        [r[1] for r, h in zip(ROWS, held, strict=True) if not h], [r[1] for r in ROWS]), strict=True)), key=repr)
    got = sorted(map(tuple, katz.score_documents(df).collect()), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_katz_with_few_classes_is_still_a_distribution(spark, monkeypatch):
    """Most words share class 0: the probabilities of all words after one still sum to one."""
    monkeypatch.setattr(katz, "FREQUENT", 30)
    train = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    words = sorted({w for r in train.collect() for w in r["text"].encode().lower().split()})
    first = [b"the", words[5], b"never-met-before"]
    tests = [(i * 100_000 + j, (v + b" " + w).decode()) for i, v in enumerate(first) for j, w in enumerate(words)]
    tests += [(i * 100_000 + 99_998, (v + b" never-met-either").decode()) for i, v in enumerate(first)]
    tests += [(i * 100_000 + 99_999, v.decode()) for i, v in enumerate(first)]
    df = spark.createDataFrame(tests, "doc_id long, text string")
    scores = {r["key"]: r["score"] for r in katz.katz_scores(train, df, F.col("doc_id")).collect()}
    model, *_ = katz.learn(train)
    assert len(model.keys) < 40 < len(words)
    # P(v w end) summed over w with P(end | w) taken off needs P(v w): score the pair by the difference to a longer text
    end = {r["key"]: r["score"] for r in katz.katz_scores(
        train, spark.createDataFrame([(j, w.decode() + " x") for j, w in enumerate(words)], "doc_id long, text string"),
        F.col("doc_id")).collect()}
    assert len(scores) == len(tests) and all(s < 0 for s in scores.values()) and len(end) == len(words)
    p0 = 10 ** model.log_p1[0]
    assert p0 + sum(10 ** model.log_p1[1:]) == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize("tokens_each", [katz.TOKENS_EACH, 200])
def test_katz_gives_rare_words_their_own_pairs(spark, tokens_each, monkeypatch):
    """With hardly any word sent to the tasks, the model is the same: no word shares its pairs with others."""
    monkeypatch.setattr(katz, "FREQUENT", 30)
    monkeypatch.setattr(katz, "TOKENS_EACH", tokens_each)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80)
    texts = [r["text"] for r in docs.select("text").collect()]
    train = spark.createDataFrame([(t,) for t in texts[:60]], "text string")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert len(katz.learn(train)[0].keys) < 40
    got = sorted(map(tuple, katz.katz_scores(train, df, F.col("doc_id")).select(
        "key", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()))
    for g, w in zip(got, brute_katz(texts[:60], texts), strict=True):
        assert g[1:] == pytest.approx(w, rel=1e-9)


def test_katz_with_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = katz.katz_scores(df.where("1 = 0"), df, F.col("doc_id")).collect()
    assert sorted((r["key"], r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in got) == [(1, 3, 0, 0, 0), (2, 1, 0, 0, 0)]


# ---------------------------------------------------------------- language ID


def best_path(rows, table, switch):
    best = [(float(s), [k]) for k, s in enumerate(table[rows[0]])]
    for t in rows[1:]:
        best = [max((b - switch * (p[-1] != k) + float(table[t][k]), [*p, k]) for b, p in best) for k in range(table.shape[1])]
    return max(best)[0]


def test_viterbi_and_its_shortcut():
    rng = np.random.default_rng(3)
    table = rng.normal(0, 4, (200, 4)).astype(np.float32)
    table[:100, 0] += 5
    table -= table.max(1, keepdims=True)

    def value(path, rows):
        return sum(float(table[t][k]) for t, k in zip(rows, path, strict=True)) - 6.0 * sum(a != b for a, b in zip(path, path[1:]))

    short = 0
    for _ in range(60):
        texts = [rng.integers(0, rng.choice([100, 200]), rng.integers(1, 40)).astype(np.int32) for _ in range(5)]
        for rows, path in zip(texts, language_id.viterbi(texts, table, 6.0), strict=True):
            want = best_path(rows, table, 6.0)
            assert value(path.tolist(), rows) == pytest.approx(want, abs=1e-3)
            if (one := language_id.one_language(table[rows], 6.0)) is not None:
                short += 1
                assert value([one] * len(rows), rows) == pytest.approx(want, abs=1e-3)
    assert short > 20


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = out.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 200 and right >= 0.98 * n


def test_language_awkward_rows(spark):
    df = edge_docs(spark)
    got = {r["doc_id"]: r for r in language_id.identify(df).collect()}
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} >= {3, 4, 5, 18}
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert all(r["lang_pred"] in {"en", "fr", "de", "ja", "und"} for r in got.values())
    assert got[1]["lang_pred"] == "en" and got[7]["lang_pred"] == "fr"
    nothing = language_id.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert language_id.identify(empty_docs(spark)).count() == 0


def test_language_spans_and_scripts(spark):
    train = spark.createDataFrame([("en", "the cat and the dog are in the house with all of them " * 5),
                                   ("fr", "le chat et le chien sont dans la maison avec tous les autres " * 5),
                                   ("ru", "кот и собака в доме " * 5), ("el", "η γάτα και ο σκύλος " * 5)], "lang string, text string")
    model = language_id.learn(train)
    text = "the dog and the cat are in the house le chien et le chat sont dans la maison кот в доме"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = language_id.label_spans(docs, model, F.col("doc_id")).first()["spans"]
    assert [s["lang"] for s in spans] == ["en", "fr", "ru"]
    assert text[spans[1]["start"]:spans[1]["end"]].startswith("le chien")
    assert language_id.WORDS.findall("αβγabcдом 12 漢字かな") == ["αβγ", "abc", "дом", "漢字", "かな"]


# ---------------------------------------------------------------- mixing


@pytest.mark.parametrize("targets, others", [({"a": 5, "b": 1, "c": 2}, 1), ({"a": 1, "b": 1}, 7), ({}, 3)])
def test_mix_stays_within_one_block_of_every_share(spark, targets, others):
    sizes = {"a": 37, "b": 11, "c": 64, "d": 9, None: 3}
    data = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(data, "doc_id long, source string")
    got = mixing.mix(docs, targets, others, 1).orderBy("_slot").collect()
    assert [r["_slot"] for r in got] == list(range(len(data))) == [r["_position"] for r in got]
    weight = [targets[x] for x in sorted(targets)] + [others]
    blocks = Counter(r["_lane"] for r in got)
    done, time = Counter(), Counter()
    for r in got:
        done[r["_lane"]] += 1
        live = [k for k in blocks if done[k] < blocks[k] or k == r["_lane"]]
        for k in live:
            time[k] += weight[k] / sum(weight[j] for j in live)
        if all(done[k] + weight[k] <= blocks[k] for k in blocks):  # every source has a whole period left
            assert all(abs(done[k] - time[k]) < 1 for k in blocks)


def test_mix_keeps_rows_and_columns(spark):
    df = edge_docs(spark)
    out = mixing.mix(df, block=2)
    assert out.columns == [*df.columns, "_lane", "_block", "_slot", "_position"]
    assert Counter(out.select(*df.columns).collect()) == Counter(df.collect())
    assert sorted(r["_position"] for r in out.collect()) == list(range(df.count()))
    assert set(CLASHES) < set(out.columns) and mixing.mix(empty_docs(spark)).count() == 0
