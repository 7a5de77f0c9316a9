"""Conversation repair against a brute-force version; toxicity on held-out rows and against a plain sum."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import CLASHES, as_tables, edge_docs, empty_docs
from linestream.llm import catalog, repair, toxicity

SF = "/root/testdata/sf0.01"

# ---------------------------------------------------------------- conversations


def best_audit(rows):
    """Least (cost, audit) over every edit; rows are (initial, deleted for sure, truncated).

    From the last row to the first: for each last role so far ("" at the start), the best that can follow."""
    due = {"": "u", "s": "u", "u": "a", "a": "u"}
    rest = {k: (0, "") if k in ("", "a") else (10 ** 9, "") for k in due}

    def with_inserts(plain):
        best = dict(plain)
        for _ in range(3):  # at most three in a row
            best = {k: min(plain[k], (best[due[k]][0] + 3, "I" + best[due[k]][1])) for k in due}
        return best

    rest = with_inserts(rest)
    for initial, must, cut in reversed(rows):
        here = {}
        for k in due:
            options = [(rest[k][0] + 4, "D" + rest[k][1])]
            if not must:
                if initial == due[k] or (initial == "s" and k == ""):
                    options.append((rest[initial][0] + 3 * cut, "K" + rest[initial][1]))
                options.append((rest[due[k]][0] + 3 + 3 * cut, "R" + rest[due[k]][1]))
            here[k] = min(options)
        rest = with_inserts(here)
    return rest[""]


def brute_repair(rows):
    """rows: (conv_id, turn, role, text) -> {conv_id: result}."""
    convs = {}
    for conv, turn, role, text in rows:
        out = convs.setdefault(conv, [])
        role, text = (" " if role is None else role), (" " if text is None else text)
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        role = "user" if draw == 4 else role
        out.extend([(turn, role, text)] * (2 if draw == 3 else 1))
    result = {}
    for conv, out in convs.items():
        out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for turn, role, text in out:
            found = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not found else "duplicate" if (role, text) in seen else
                          "truncated" if found[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = best_audit([(r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(out, faults, strict=True)])
        lines, i, last = [], 0, ""
        for letter in audit:
            due = {"u": "assistant"}.get(last, "user")
            if letter == "I":
                lines.append(f"{due}:")
                last = due[0]
                continue
            turn, role, text = out[i]
            i += 1
            if letter == "D":
                continue
            lines.append(f"{role if letter == 'K' else due}:{text}")
            last = role[0] if letter == "K" else due[0]
        turns = {r[0] for r in out} - {None}
        result[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                        faults.count("truncated"), sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(out, out[1:])),
                        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


def test_runs_equal_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(600):
        n = int(rng.integers(0, 9))
        symbols = np.repeat(rng.integers(0, 16, n), rng.integers(1, 4, n)).astype(np.uint8)
        rows = [("sua "[s % 4].strip(), s // 4 >= 2, s // 4 == 1) for s in symbols.tolist()]
        assert repair.repair(symbols) == best_audit(rows)


def test_long_runs_by_binary_powers(monkeypatch):
    symbols = np.repeat(np.array([1, 2, 9, 0, 1, 6], np.uint8), [37, 41, 23, 3, 50, 20])
    rows = [("sua "[s % 4].strip(), s // 4 >= 2, s // 4 == 1) for s in symbols.tolist()]
    want = best_audit(rows)
    for most in (1, 2, 7, 4096):
        monkeypatch.setattr(repair, "UNROLLED", most)
        assert repair.repair(symbols) == want
    cost, audit = repair.repair(np.full(300_000, 1, np.uint8))  # a user says 300,000 things
    assert len(audit) >= 300_000 and cost > 0


def test_conversations_equal_brute_force(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    want = brute_repair([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    got = {r[0]: tuple(r)[1:] for r in catalog.QUERIES["op13_conversation_repair"](spark, SF).collect()}
    assert got == want


CONVERSATION = "conv_id long, turn int, role string, text string"


def awkward_rows():
    rng = np.random.default_rng(11)
    rows = []
    for conv in [None, *range(40)]:
        for turn in rng.permutation(12)[:rng.integers(1, 12)].tolist():
            for _ in range(rng.integers(1, 3)):
                rows.append((conv, None if rng.random() < 0.1 else turn, rng.choice(["system", "user", "assistant", "tool", "", None]),
                             rng.choice(["Yes.", "No!", "Why", "", " \n", None, "a" * 70_000 + "?"])))
    rows += [(50, t, "user" if t % 2 else "assistant", "Same.") for t in range(2000)]  # one long conversation of copies
    rows += [(51, 1, "user", "Copy.")] * 500  # repeated rows
    rows += [(52, t, "user" if t % 2 else "assistant", f"Turn {t}") for t in range(1500)]
    return [(a, b, None if c is None else str(c), None if d is None else str(d)) for a, b, c, d in rows]


def test_awkward_conversations(spark, monkeypatch):
    monkeypatch.setattr(repair, "ROWS_PER_PIECE", 100)  # long conversations are cut
    rows = awkward_rows()
    df = spark.createDataFrame(rows, CONVERSATION).repartition(7).select("*", *[F.lit(c).alias(c) for c in CLASHES if c not in ("text",)])
    got = {r[0]: tuple(r)[1:] for r in repair.repair_damaged(df).collect()}
    short = [r for r in rows if r[0] not in (50, 51, 52)]
    want = brute_repair(short)
    assert {c: got[c] for c in want} == want
    for conv in (51, 52):
        own = brute_repair([r for r in rows if r[0] == conv])[conv]
        assert got[conv] == own
    assert set(got) == {r[0] for r in rows} and len(got[50][6]) >= 2000 - 200


def test_no_conversations(spark):
    df = spark.createDataFrame([], CONVERSATION)
    assert repair.repair_damaged(df).count() == 0
    conv = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = repair.repair_damaged(spark.createDataFrame([(conv, 0, "user", "Gone.")], CONVERSATION)).collect()
    assert [tuple(r) for r in got] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repair_without_damage(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello.")]
    got = repair.repair_rows(repair.as_rows(spark.createDataFrame(rows, CONVERSATION))).collect()[0]
    assert (got["cost"], got["audit"]) == (0, "KKK")
    assert got["repaired_sha256"] == hashlib.sha256(b"system:Be kind.\nuser:Hi.\nassistant:Hello.").hexdigest()


# ---------------------------------------------------------------- toxicity


def test_toxicity_on_held_out_rows(spark):
    """Held-out documents: labels carry noise, so the mark is what separates them at all."""
    sf = "/root/testdata/sf0.1"
    got = catalog.QUERIES["op11_toxicity"](spark, sf)
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    pos, neg = [r for r in rows if r["toxic"] == 1], [r for r in rows if r["toxic"] == 0]
    assert np.mean([r["predicted"] for r in pos]) >= 0.9
    assert np.mean([r["predicted"] for r in neg]) <= 0.01
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got.where("score < 0 or score > 1 or score is null or predicted != cast(score >= 0.3 as int)").count() == 0


def test_a_score_is_the_sum_over_ngrams():
    """Cached word sums against counting every n-gram of every word by hand."""
    rng = np.random.default_rng(3)
    weights = rng.normal(size=toxicity.TABLE).astype(np.float32)
    scorer = toxicity.Scorer({"weights": weights, "constant": -1.5})
    for text in ("", None, "...", "a", "You idiot, you IDIOT!", "日本語 русский ß", "x" * 5000):
        want = -1.5
        for word in set(re.findall(r"\w+", (text or "").lower())):
            want += math.fsum(weights[toxicity.ngrams([word])[1]].tolist())
        assert scorer.logit(text) == pytest.approx(want, abs=1e-3)
    owner, slot = toxicity.ngrams(["ab", "c"])
    assert Counter(owner.tolist()) == {0: 3, 1: 1}  # ^ab ab$ ^ab$ and ^c$
    assert len(set(slot.tolist())) == 4


def test_log_count_ratios():
    toxic, clean = np.array([9.0, 1, 0, 0]), np.array([1.0, 89, 100, 0])
    share = 10 / 200
    want = [math.log((t + toxicity.ALPHA * share) / (c + toxicity.ALPHA * (1 - share)) / (share / (1 - share)))
            for t, c in zip(toxic, clean, strict=True)]
    assert toxicity.log_count_ratios(toxic, clean) == pytest.approx(want, rel=1e-5)
    assert abs(toxicity.log_count_ratios(toxic, clean)[3]) < 1e-6


LABELS = "doc_id long, quality int, toxic int, score int"


def test_toxicity_of_awkward_rows(spark):
    df = edge_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0, 1), (2, 1, 1, 1), (2, 1, 0, 1), (3, 0, 0, 1), (4, 0, None, 1), (None, 0, 1, 1), (8, 1, 1, 1),
                                    (9, 1, 1, 1), (10, 1, 0, 1), (99, 1, 1, 1)], LABELS)
    out = toxicity.toxicity(df, labels)
    got = out.collect()
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in df.select("doc_id").collect())
    assert all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (3, 4, 5)}) == 1  # no words: the constant
    none = toxicity.toxicity(df, labels.where("1 = 0")).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.0, 0)}
    one = toxicity.toxicity(df, labels.where("toxic = 0")).collect()
    assert {r["predicted"] for r in one} == {0}
    assert toxicity.toxicity(empty_docs(spark), labels).count() == 0


def test_toxicity_does_not_read_labels_for_scores(spark, tmp_path):
    """Held-out labels, and everything but the text, leave the scores alone."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string"))
    key = lambda df: sorted((r["doc_id"], r["score"]) for r in df.collect())
    assert key(toxicity.toxicity(docs, labels)) == key(toxicity.toxicity(other, flipped))
