"""Cross-tokenizer alignment against a brute-force version."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from helpers import ROWS, edge_docs
from linestream.llm import alignment, catalog

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    unprinted = [b for b in range(256) if b not in letters]
    byte_of = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(unprinted)}
    return a, byte_of, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(tokenizers, text):
    """[(id, bytes)] of A and of B; nothing if they do not give the text back."""
    a, byte_of, b = tokenizers
    if not text:
        return [], []
    left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()))
    want = b" " + text.encode()
    ok = b"".join(x for _, x in left) == want == b"".join(x for _, x in right)
    return (left, right) if ok else ([], [])


def groups(left, right):
    out, i, j = [], 0, 0
    while i < len(left):
        ga, gb, na, nb = [], [], 0, 0
        while not ga or na != nb:
            if na <= nb:
                ga.append(left[i][0])
                na += len(left[i][1])
                i += 1
            else:
                gb.append(right[j][0])
                nb += len(right[j][1])
                j += 1
        out.append((ga, gb))
    return out


def brute(tokenizers, texts):
    docs = [tokens(tokenizers, t) for t in texts]
    cut = [groups(*d) for d in docs]
    links = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for g in cut]
    docs_of = Counter(pair for one in links for pair in one)
    best = defaultdict(int)
    for (x, _), n in docs_of.items():
        best[x] = max(best[x], n)
    out = []
    for (left, right), g, one in zip(docs, cut, links, strict=True):
        written = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in g)
        out.append((len(left), len(right), len(g), sum(one.values()), sum(n for p, n in one.items() if docs_of[p] == best[p[0]]),
                    sum(n * docs_of[p] for p, n in one.items()), hashlib.sha256(written.encode()).hexdigest() if left else ""))
    return out


def test_query_equals_brute_force(spark, tokenizers):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = Counter((r["doc_id"], *w) for r, w in zip(rows, brute(tokenizers, [r["text"] for r in rows]), strict=True))
    got = catalog.QUERIES["op12_tokenizer_alignment"](spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == want


HARD = ["x" * 3000, "ab" * 900 + " ▁ ", "▁", " ", "  two  spaces ", "\n\n\t", "a\r\nb", "<|endoftext|> <s> </s> <0x0A>", "\U0001f600‍\U0001f525 é ß",
        "日本語のテキスト。" * 200, "\x00\x01", "русский текст", "don't we'll 12345678901234567890", " 　", "ﬁ Å", "=" * 500 + "-" * 300]


def test_awkward_texts_equal_brute_force(spark, tokenizers):
    texts = [r[1] for r in ROWS] + HARD * 3 + ["x" * 3000, None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in alignment.align(df, A, B).collect()}
    want = brute(tokenizers, texts)
    assert [got[i] for i in range(len(texts))] == want
    assert want[-1] == want[-2] == (0, 0, 0, 0, 0, 0, "")
    assert brute(tokenizers, ["▁"]) == [(0, 0, 0, 0, 0, 0, "")]  # not given back byte for byte


def test_ids_of_the_file(spark, tokenizers, tmp_path):
    """Ranks and the file's own library agree; a file whose ids do not follow its merges goes by the library."""
    import json

    texts = [r[1] for r in ROWS if r[1]] + HARD + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r["text"]]
    fast = alignment.ByteTokens(A)
    assert fast.ranked is not None
    assert fast.encode(texts) == [e.ids for e in tokenizers[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]
    spec = json.load(open(A, encoding="utf-8"))
    v = spec["model"]["vocab"]
    first, second = (next(t for t, i in v.items() if i == n) for n in (300, 301))
    v[first], v[second] = 301, 300
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec))
    other = alignment.ByteTokens(str(path))
    assert other.ranked is None
    assert all(b"".join(other.bytes[i] for i in ids) == (" " + t).encode() for t, ids in zip(texts, other.encode(texts), strict=True))


def test_awkward_columns(spark):
    got = alignment.align(edge_docs(spark), A, B)
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(r[0] for r in ROWS)


def test_bitmaps_round_trip(monkeypatch):
    monkeypatch.setattr(alignment, "DENSE", 50)
    rng = np.random.default_rng(2)
    sets = [np.sort(rng.choice(alignment.BLOCK, n, replace=False)) for n in (1, 49, 50, 3000, 2, 0, 65536, 7) if n]
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    data, ends = alignment.containers(np.concatenate(sets), starts)
    places, owner = alignment.places_of(data, ends)
    for i, s in enumerate(sets):
        assert places[owner == i].tolist() == s.tolist()
    assert np.diff(ends, prepend=0).max() == alignment.BLOCK // 8


@pytest.mark.parametrize("dense, listed", [(3, 1), (4096, 10_000)])
def test_block_planes(monkeypatch, dense, listed):
    """Documents and links of every pair come back from its bitmap and planes."""
    monkeypatch.setattr(alignment, "DENSE", dense)
    monkeypatch.setattr(alignment, "PAIRS_LISTED", listed)
    aligner = alignment.Aligner(A, B)
    texts = ["the cat and the dog " * 5, "x" * 400, "the the the", "", None, "a cat", *["one more cat"] * 20]
    block, want = alignment._Block(), Counter()
    for begin in range(0, len(texts), 4):
        some = texts[begin:begin + 4]
        found, links = aligner.align(some)
        for key, n in zip(*map(np.ndarray.tolist, links), strict=True):
            want[key & 0xFFFFFFFF, block.documents + (key >> 32)] += n
        block.add(*links)
        block.documents += len(some)
    pairs, planes = block.rows()
    got = Counter()
    for pair, maps in zip(pairs.to_pylist(), planes.to_pylist(), strict=True):
        for plane, m in enumerate(maps):
            data = np.frombuffer(m, np.uint8)
            for place in alignment.places_of(data, np.array([len(data)]))[0].tolist() if len(data) else []:
                got[pair, place] += 1 << max(plane - 1, 0)
    assert got == want
    batch = pa.RecordBatch.from_arrays(
        [pa.array([5] * len(pairs) * 1), pa.array([3] * len(pairs)), pa.array([1] * len(pairs)), pa.array([0] * len(pairs), pa.int32()),
         pa.array([m[0] for m in planes.to_pylist()], pa.binary())], names=["block", "docs", "best", "plane", "bitmap"])
    sums = next(alignment._sums(iter([batch])))
    per_doc = Counter(d for _, d in want)
    assert dict(zip(sums["place"].to_pylist(), sums["count_sum"].to_pylist(), strict=True)) == {d: 3 * n for d, n in per_doc.items()}
