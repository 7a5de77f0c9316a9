"""Strict CSV (D-4) on an edge table and against Python's reader; transforms by path (UDF-1)."""

import csv
import io
import json
import random
import sys

import pytest
from pyspark.sql import functions as F

from linestream.functions.text import strict_csv
from linestream.operators import parse as P
from linestream.operators import registry as R


def _fields(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    return [r.t for r in df.select("i", strict_csv(F.col("value")).alias("t")).orderBy("i").collect()]


@pytest.mark.parametrize("line, fields", [
    ("a,b", ["a", "b"]), ("a,,b", ["a", "", "b"]), (",", ["", ""]), ("", [""]), ("a,", ["a", ""]), ('"a,b",c', ["a,b", "c"]),
    ('"a""b"', ['a"b']), ('""', [""]), ('"",""', ["", ""]), ('""""', ['"']), ('"a"",""b",c', ['a","b', "c"]), (' "a"', None), ('a"b', None),
    ('"a', None), ('"a"b', None), ('"a" ,b', None), ('a,"b,c', None), (None, None), ("a\x01b,\x01e", ["a\x01b", "\x01e"]),
    ('"\x01,",\x01', ["\x01,", "\x01"]), ('"x\ny",z', ["x\ny", "z"])])
def test_strict_csv_edge_table(spark, line, fields):
    assert _fields(spark, [line]) == [fields]


def test_strict_csv_reads_what_a_writer_writes(spark):
    rnd = random.Random(6)
    rows = [[" ".join(rnd.choice(['a', '"', ',', '""', 'b c', '', "'"]) for _ in range(rnd.randrange(3))) for _ in range(rnd.randrange(1, 6))]
            for _ in range(300)]
    lines = []
    for r in rows:
        out = io.StringIO()
        csv.writer(out, lineterminator="", quoting=rnd.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])).writerow(r)
        lines.append(out.getvalue())
    assert _fields(spark, lines) == rows


def test_strict_parse(spark):
    lines = spark.createDataFrame([(1, '5,7,d,"a,""b""",1.0,2.0,3,4'), (2, '5,7,"d,r,1.0,2.0,3,4'), (3, "5,7,,r,1.0,2.0,3,4"), (4, None), (5, "5,7")],
                                  "event_id int, value string")
    got = {r.event_id: (r.rt, r.dtg, r.error) for r in P.simfile_typed(lines, strict=True).collect()}
    assert got == {1: ('a,"b"', "d", None), 2: (None, None, "bad_quotes"), 3: ("r", "", None), 4: (None, None, "null_line"),
                   5: (None, None, "missing_field")}


MODULE = '''
from pyspark.sql import functions as F
from linestream.operators.registry import of_frames

SUFFIX = "!"

def shout(line, mark=SUFFIX):
    if line == "bad":
        raise ValueError("no such line")
    return None if line == "drop" else line.upper() + mark

class Counting:
    made = 0
    def __init__(self, prefix="n"):
        Counting.made += 1
        self.prefix, self.n = prefix, 0
    def transform(self, line):
        self.n += 1
        return f"{self.prefix}{Counting.made}:{line}"

class NoTransform:
    pass

@of_frames
def longer(lines, by=1):
    return lines.withColumn("value", F.concat("value", F.repeat(F.lit("."), by)))

NOT_CALLABLE = 3
'''


@pytest.fixture(scope="module")
def user_module(tmp_path_factory):
    """A module only the driver can import."""
    folder = tmp_path_factory.mktemp("user")
    (folder / "their_transforms.py").write_text(MODULE)
    sys.path.insert(0, str(folder))
    yield "their_transforms"
    sys.path.remove(str(folder))


def _apply(spark, name, values, **settings):
    df = spark.createDataFrame([(i, v, "kept") for i, v in enumerate(values)], "i int, value string, other string").repartition(2)
    out = R.apply(name, df, **settings)
    assert out.columns == ["i", "value", "other"]
    return [r.value for r in out.orderBy("i").collect()]


def test_a_function_by_path(spark, user_module):
    got = _apply(spark, f"{user_module}.shout", ["a", "bad", "drop", None, ""])
    assert got == ["A!", json.dumps({"error": "ValueError: no such line"}), "", json.dumps({"error": "null_line"}), "!"]
    assert _apply(spark, f"{user_module}.shout", ["a"], mark="?") == ["A?"]
    df = spark.createDataFrame([(v,) for v in ("a", "drop")], "value string")
    assert [r.value for r in R.drop_empty(R.apply(f"{user_module}.shout", df)).collect()] == ["A!"]


def test_a_class_by_path_is_made_once_a_task(spark, user_module):
    df = spark.createDataFrame([(v,) for v in "abcdef"], "value string").coalesce(1)
    got = sorted(r.value for r in R.apply(f"{user_module}.Counting", df, prefix="p").collect())
    assert got == [f"p1:{c}" for c in "abcdef"]


def test_a_frame_transform_by_path(spark, user_module):
    assert _apply(spark, f"{user_module}.longer", ["a", None], by=2) == ["a..", None]


@pytest.mark.parametrize("name", ["nothing", "no.such.module", "their_transforms.missing", "their_transforms.NoTransform",
                                  "their_transforms.NOT_CALLABLE"])
def test_an_unknown_transform_fails(spark, user_module, name):
    with pytest.raises(ValueError):
        R.get(name)
