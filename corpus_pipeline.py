"""From raw documents to packed training sequences.

Each stage calls one operator of `linestream.llm` on all that the stage before
it kept; its result is written as Parquet into the shared folder and read
again as the next stage's documents. All stages but the last return the
columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linestream.llm import language_id, line_dedup, mixing, packing, simhash
from linestream.llm.common import documents, ship_code, written
from linestream.operators.running import running_sum
from linestream.operators.sizing import checked_broadcast
from linestream.session import ensure_defaults

#: A text is rejected if its letters have less evidence than this for the learned languages (`language_id.predict`: 1 is
#: what labelled texts have on average, 0 what text of no language has; texts in two or three languages stay).
LEAST_EVIDENCE = 0.2
SHINGLE, BITS = 3, 2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID, learned from all labelled rows. Texts without letters (null and
    empty ones too), junk and texts in languages nobody was learned with go; a
    missing label is filled in. Repeated rows are judged alike, long texts
    whole; other columns are kept. Without any labelled row every text goes."""
    model = language_id.learn(docs)
    found = language_id.predict(docs, model, F.struct("*"), docs.schema)
    lang = F.coalesce(F.col("key.lang"), F.col("lang_pred"))
    kept = found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("evidence") >= LEAST_EVIDENCE))
    return kept.select(*[lang.alias(c) if c == "lang" else F.col("key")[c].alias(c) for c in docs.columns])


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: repeated chunks of lines are cut out; n_chars follows the text.
    Every row stays (a text may end up empty); the first of equal chunks stays,
    by id, then text; repeated rows are one document; a null text stays null."""
    out = line_dedup.line_dedup(docs)
    n = F.char_length("text").cast("long")
    return out.select(*[F.when(F.col("_n_removed") > 0, n).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(c)
                        for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: the smallest doc_id of each component stays, a null id
    after all others; of repeated rows of that id any one. Null and empty texts
    have fingerprint zero and are one component."""
    return simhash.keep_one(docs, SHINGLE, BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: all rows, repeated ones too, in files that follow the mixed order; an
    unlisted or null source is the last lane. Texts are not read."""
    return mixing.mix(docs).orderBy("_position").select(*docs.columns)


def in_file_order(docs: DataFrame) -> DataFrame:
    """text, doc_id and `_position` (gapless from 0): the order of a written table's files and of the rows in them."""
    rows = docs.select("doc_id", "text", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias("_file"),
                       F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("n"))  # a row a file
    upto = running_sum(files, [], "_file", F.col("n"), "_upto")
    before, _small = checked_broadcast(upto.select("_file", (F.col("_upto") - F.col("n")).alias("_before")))
    return rows.join(before, "_file").select("doc_id", "text", (F.col("_before") + F.col("_row")).alias("_position"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of all that is left; the sequences follow the mixed order,
    which is that of the files. Null and empty texts are one closing token."""
    import public_tokenizers

    return packing.best_fit_packing(in_file_order(docs), public_tokenizers.path("word_bpe_49k.json"), position_col="_position")


STAGES = [
    ("language ID", identify_language),
    ("line dedup", remove_repeated_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SimHash, the trained language model and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_defaults(spark)
    ship_code(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return docs
