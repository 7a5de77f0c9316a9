"""The pipeline, stage by stage, against brute force."""

import re
from collections import Counter

import corpus_pipeline
from helpers import as_tables, edge_docs, empty_docs
from linestream.llm import catalog
from linestream.llm.common import written
from oracle_harness import duck
from test_dedup import brute_components, brute_fingerprint
from test_models import TOKENIZER, check_packing, token_ids

SF = "/root/testdata/sf0.001"


def stages(spark, docs, sf_dir):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf_dir), "test"))
    return out


def check(spark, folder, con):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    raw, lang, lines, near, mixed, packed = stages(spark, docs, folder)
    assert raw.columns == lang.columns == lines.columns == near.columns == mixed.columns

    before, after = raw.collect(), lang.collect()
    texts = Counter((r["doc_id"], r["text"]) for r in after)
    assert not texts - Counter((r["doc_id"], r["text"]) for r in before)
    assert all(re.search(r"[^\W\d_]", r["text"]) and r["lang"] for r in after)

    con.register("kept", lang.select("doc_id", "text").toPandas())
    want = con.execute(catalog.line_dedup_sql("kept")).fetchall()
    assert Counter((r["doc_id"], r["text"]) for r in lines.collect()) == Counter(
        (None if i is None or i != i else int(i), clean) for i, _, clean, _, _ in want)
    cut = {(r["doc_id"], r["text"]) for r in lines.collect()} - {(r["doc_id"], r["text"]) for r in after}
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect() if (r["doc_id"], r["text"]) in cut)

    data = [(r["doc_id"], r["text"]) for r in lines.collect()]
    comp = brute_components([brute_fingerprint(t) for _, t in data])
    low = {}
    for c, (i, _) in zip(comp, data, strict=True):
        low[c] = i if low.get(c) is None else low[c] if i is None else min(i, low[c])
    assert sorted(map(repr, low.values())) == sorted(repr(r["doc_id"]) for r in near.collect())
    assert Counter(near.collect()) == Counter(mixed.collect())

    pieces = packed.collect()
    check_packing(pieces, 2048)
    assert sum(r["length"] for r in pieces) == sum(len(token_ids(r["text"])) for r in mixed.collect())
    return pieces


def test_pipeline_stages(spark):
    pieces = check(spark, SF, duck(SF))
    again = corpus_pipeline.run(spark, SF)
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[k] for k in key) for r in again.collect()) == Counter(tuple(r[k] for k in key) for r in pieces)
    assert TOKENIZER.endswith("word_bpe_49k.json")


def test_pipeline_awkward_rows(spark, tmp_path):
    folder, con = as_tables(spark, tmp_path, edge_docs(spark))
    assert check(spark, folder, con)


def test_pipeline_empty_table(spark, tmp_path):
    folder, _ = as_tables(spark, tmp_path, empty_docs(spark))
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_stage_list():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_sequences_follow_the_mix(spark, monkeypatch):
    """A prefix of the sequences holds the target shares, not the natural ones."""
    monkeypatch.setattr(corpus_pipeline.packing, "STRETCH", 300)
    docs = [(i, " ".join(f"w{(i * 7 + j) % 997}" for j in range(20 + i * 37 % 300)), f"src{min(i % 8, 2)}") for i in range(2400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    mixed = written(corpus_pipeline.mix_sources(spark, df, SF), "test")
    packed = written(corpus_pipeline.pack_sequences(spark, mixed, SF), "test").collect()
    check_packing(packed, 2048)
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(range(2400))
    source = {i: s for i, _, s in docs}
    last = max(r["sequence_id"] for r in packed)
    assert len({r["sequence_id"] for r in packed}) == last + 1
    # src0 5, src1 1 and src2 1 slots of 7; src0 has 300 rows, an eighth of all, all of them in the first 420 of the mix
    head = Counter(source[r["doc_id"]] for r in packed if r["sequence_id"] < last // 12)
    assert abs(head["src0"] / sum(head.values()) - 5 / 7) < 0.1
    assert not any(source[r["doc_id"]] == "src0" for r in packed if r["sequence_id"] > last // 2)


JUNK = {
    "letters": "qzxv wkpt bnmq jjxz vvkw pqzt xxwv kkjq zzpt mwqx " * 8, "base64": "U2FsdGVkX1+9kZQw3hT7vYx0QmJ6bE5PcGxxUmZzZ3RoanVr" * 4,
    "polish": "W środę rano wszyscy mieszkańcy miasteczka zebrali się na rynku, żeby posłuchać przemówienia burmistrza o nowej szkole i drodze.",
    "japanese": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "russian": "Все люди рождаются свободными и равными в своем достоинстве и правах.", "digits": "12345 !!! ...", "empty": "", "null": None}


def test_language_stage_rejects_junk_and_unlearned_languages_and_keeps_clean_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = docs.count()
    texts = [r["text"] for r in docs.where("lang = 'de'").limit(3).collect()] + [r["text"] for r in docs.where("lang = 'fr'").limit(3).collect()]
    mixed = [(2_000_000 + i, a[:400] + "\n" + b[:400]) for i, (a, b) in enumerate(zip(texts[:3], texts[3:], strict=True))]
    rows = [(1_000_000 + i, t, None, "src0", None) for i, t in enumerate(JUNK.values())] + [(i, t, None, "src0", len(t)) for i, t in mixed]
    more = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, more, SF).select("doc_id").collect()}
    assert len([i for i in kept if i < 1_000_000]) >= 0.99 * clean
    assert not [list(JUNK)[i - 1_000_000] for i in kept if 1_000_000 <= i < 2_000_000]
    assert {i for i, _ in mixed} <= kept


def test_packing_runs_in_as_many_tasks_as_stretches(spark, monkeypatch):
    from linestream.llm import packing
    from pyspark.sql import functions as F

    monkeypatch.setattr(packing, "STRETCH", 10)
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.col("id").alias("_p"))
    out = packing.best_fit_packing(docs, TOKENIZER, position_col="_p")
    assert check_packing(out.collect(), 2048) == 20
    n = packing.partitions_for(spark, 200, 10)
    assert n == 20
    first = {r["doc_id"]: r["sequence_id"] for r in out.collect()}
    assert all(first[i] <= first[i + 10] for i in range(190))
