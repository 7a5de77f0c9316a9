"""Small inputs with every awkward case, and brute-force versions."""

import duckdb
from pyspark.sql import types as T

LONG = " ".join(f"word{i % 977} the of and" for i in range(12_000))  # about 200 kB
LINES = "alpha line one here\nbeta line two here\ngamma line three\ndelta line four\nepsilon line five\nzeta line six\neta seven"
PASSAGE = " ".join(f"shared{i}" for i in range(60))

#: doc_id, text, lang, source, n_chars; then columns whose names the operators use inside.
ROWS = [
    (1, "The cat and the dog are in the house of the man.", "en", "src0", 48, "x", 1),
    (2, "The cat and the dog are in the house of the man.", "en", "src0", 48, "x", 2),
    (2, "The cat and the dog are in the house of the man.", "en", "src0", 48, "x", 2),
    (3, None, "en", "src1", None, None, None),
    (4, "", "fr", None, 0, "y", 4),
    (5, "   \n\t ", None, "src1", 6, "y", 5),
    (None, "Le chat et le chien sont dans la maison de la dame.", "fr", "src2", 51, "z", 6),
    (None, "Le chat et le chien sont dans la maison de la dame.", "fr", "src2", 51, "z", 6),
    (None, None, None, None, None, None, None),
    (7, "Le chat et le chien sont dans la maison de la dame.", "fr", "unknown source", 51, "z", 7),
    (8, LINES, "en", "src3", 100, "w", 8),
    (9, "before it\nfirst\n" + LINES + "\nafter it", "en", "src3", 120, "w", 9),
    (10, LONG, "en", "src4", len(LONG), "v", 10),
    (11, PASSAGE + " one end of a text", "en", "src4", 500, "v", 11),
    (12, "another begin " + PASSAGE, "en", "src4", 500, "v", 12),
    (13, "a", "en", "src5", 1, "u", 13),
    (14, "a", "en", "src5", 1, "u", 14),
    (15, "ab " * 150, "en", "src5", 450, "u", 15),
    (16, "x" * 700, "de", "src5", 700, "u", 16),
    (17, "日本語のテキスト。漢字とかな。 русский текст", "ja", "src6", 20, "t", 17),
    (18, "12345 !!! ...", "en", "src6", 13, "t", 18),
    (19, "Der Hund und die Katze sind in dem Haus \U0001f600 <|endoftext|> é ß", "de", "src6", 60, "t", 19),
]
NAMES = ["doc_id", "text", "lang", "source", "n_chars", "key", "n"]
SCHEMA = T.StructType([T.StructField(n, t()) for n, t in zip(
    NAMES, (T.LongType, T.StringType, T.StringType, T.StringType, T.LongType, T.StringType, T.LongType), strict=True)])
#: More names that the operators use for their own columns.
CLASHES = ["row", "id", "hash", "digest", "sha", "rank", "lane", "slot", "b", "k", "f", "s", "slice", "unit", "part", "kind", "fp",
           "gone", "clean", "t", "first", "low", "copy", "kept", "score", "length", "offset", "_bucket", "edited", "extra", "size"]


def edge_docs(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *[F.lit(c).alias(c) for c in CLASHES])


def empty_docs(spark):
    return edge_docs(spark).where("1 = 0")


def as_tables(spark, tmp_path, df, name="documents"):
    """Write a table where the queries look for it; the folder, and DuckDB on it."""
    df.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
    con = duckdb.connect()
    con.execute(f"create view {name} as select * from read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    return str(tmp_path), con


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
