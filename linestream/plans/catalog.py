"""The query catalogue: one Spark plan and one DuckDB oracle per operator.

interval 60 s, every 3rd line. Every query reads the driver tables (or data
Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bursts as B
from ..operators import batches as BA
from ..operators import parse as P
from ..operators import geotag as G
from ..sources import fences as FS
from ..sources import kafka as K
from ..sources import text as TX
from ..operators import registry as R
from ..operators.sequence import with_sequence
from ..operators.sizing import materialize
from ..sinks import index_source as IX
from ..sinks import writers as W
from ..streaming import live as L
from ..streaming import positions as PO
from ..streaming import runner as RUN
from ..streaming import streams as S
from ..session import fresh_path
from ..sources import tables as T
from . import oracle_base as O

# Fixed parameters of the query contract.
GAP_MS = 900_000
INTERVAL_MS = 60_000
EVERY_NTH = 3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# --------------------------------------------------------------------------
# Bursts (AGG-1..4)
# --------------------------------------------------------------------------

def _row_bursts(src: str) -> str:
    """Row-level burst ids in DuckDB: lag islands per topic."""
    return _ROW_BURSTS_LATENCY.replace("from latency_lines", f"from {src}")


_ROW_BURSTS_LATENCY = f"""lr AS (select topic, ms, event_id, key, value from latency_lines),
lg AS (select *, case when lag(ms) over w is null or ms - lag(ms) over w > {GAP_MS} then 1 else 0 end as s
       from lr window w as (partition by topic order by ms, event_id)),
lb AS (select *, sum(s) over (partition by topic order by ms, event_id rows unbounded preceding) as burst
       from lg)"""

_RATE_SQL = "case when max(ms) > min(ms) then cast(1000 as double) * count(*) / cast(max(ms) - min(ms) as double) end"


@query("record_count", O.with_views(
    "select topic, cast(count(*) as bigint) as n from latency_lines group by topic"))
def record_count(spark, sf_dir):
    return T.latency_lines(spark, sf_dir).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("burst_count", O.with_views(
    "select topic, min(ms) as start_ms, max(ms) as end_ms, count(*) as n from lb group by topic, burst",
    _ROW_BURSTS_LATENCY))
def burst_count(spark, sf_dir):
    return B.bursts(T.latency_lines(spark, sf_dir), GAP_MS)


@query("burst_rate", O.with_views(
    f"select topic, min(ms) as start_ms, max(ms) as end_ms, count(*) as n, {_RATE_SQL} as rate "
    "from lb group by topic, burst", _ROW_BURSTS_LATENCY))
def burst_rate(spark, sf_dir):
    return B.burst_rates(T.latency_lines(spark, sf_dir), GAP_MS)


_LATENCY_ROWS = """lv AS (select *,
    case when regexp_full_match(string_split(value, ',')[-1], '[+-]?[0-9]+')
         then try_cast(string_split(value, ',')[-1] as bigint) end as sent from lb),
lc AS (select *, min(case when sent is null then ms end) over (partition by topic, burst) as cut_ms
       from lv),
lc2 AS (select *, min(case when sent is null and ms = cut_ms then event_id end)
                  over (partition by topic, burst) as cut_id from lc),
lf AS (select *, (cut_ms is null or ms < cut_ms or (ms = cut_ms and event_id < cut_id)) as ok from lc2)"""


@query("burst_latency", O.with_views(
    f"""select topic, min(ms) as start_ms, max(ms) as end_ms, count(*) as n, {_RATE_SQL} as rate,
  cast(coalesce(sum(case when ok then ms - sent end), 0) as double) / cast(count(*) as double) as avg_latency,
  count(case when ok then 1 end) as valid_n
from lf group by topic, burst""", _ROW_BURSTS_LATENCY, _LATENCY_ROWS))
def burst_latency(spark, sf_dir):
    return B.burst_latency(T.latency_lines(spark, sf_dir), GAP_MS)


# --------------------------------------------------------------------------
# Parsing (PRJ-1..6, FLT-3)
# --------------------------------------------------------------------------

_INT_RE = "'[+-]?[0-9]+'"


def _sql_parse_cte(name: str, src: str, tokens_sql: str, fields, finite) -> str:
    """DuckDB CTE: typed fields + error for a token list (1-based lists)."""
    raws = ", ".join(f"t[{i + 1}] as r{i}" for i in range(len(fields)))
    typed = []
    reason = ["when value is null then 'null_line'"]
    for i, (fname, kind) in enumerate(fields):
        r = f"r{i}"
        if kind == "long":
            expr = f"case when regexp_full_match({r}, {_INT_RE}) then try_cast({r} as bigint) end"
        elif kind == "int":
            expr = f"case when regexp_full_match({r}, {_INT_RE}) then try_cast({r} as integer) end"
        elif kind == "double":
            expr = f"try_cast({r} as double)"
        else:
            expr = r
        typed.append(f"{expr} as p_{fname}")
        reason.append(f"when {r} is null then 'missing_field'")
        if kind != "string":
            reason.append(f"when p_{fname} is null then 'bad_{fname}'")
    for fname in finite:
        reason.append(f"when isnan(p_{fname}) or isinf(p_{fname}) then 'non_finite'")
    out = ", ".join(f"case when error is null then p_{f} end as {f}" for f, _ in fields)
    return f"""{name}_t AS (select event_id, value, {tokens_sql.format(v='value')} as t from {src}),
{name}_r AS (select event_id, value, {raws} from {name}_t),
{name}_p AS (select *, {", ".join(typed)} from {name}_r),
{name}_e AS (select *, case {" ".join(reason)} end as error from {name}_p),
{name} AS (select event_id, {out}, error from {name}_e)"""


_SPLIT_TOKENS = "string_split(regexp_replace({v}, ',+$', ''), ',')"

# The fields of the line format, spelled out apart from the parser's.
_SF_PARSE = _sql_parse_cte("sfp", "simfile_lines", O.TOKENS_SQL, [
    ("tm", "long"), ("id", "int"), ("dtg", "string"), ("rt", "string"), ("lon", "double"), ("lat", "double"),
    ("spd", "double"), ("brg", "double")], ["lon", "lat", "spd", "brg"])
_SPLIT_PARSE = _sql_parse_cte("ssp", "simfile_lines", _SPLIT_TOKENS, [
    ("tm", "long"), ("id", "string"), ("dtg", "string"), ("rt", "string"), ("lon", "double"), ("lat", "double"),
    ("speed", "double"), ("bearing", "double")], ["lon", "lat", "speed", "bearing"])
_FAA_PARSE = f"""faa_t AS (select event_id, value, {O.TOKENS_SQL.format(v='value')} as t from faa_lines),
faa_r AS (select event_id, value, t[3] as r2, t[4] as r3, t[5] as r4, t[6] as r5 from faa_t),
faa_p AS (select *, case when regexp_full_match(r3, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}( [AaPp][Mm])?')
      then epoch_ms(try_strptime(substr(r3, 1, 19), '%m/%d/%Y %H:%M:%S')) end as p_ts,
    try_cast(r4 as double) as p_lon, try_cast(r5 as double) as p_lat from faa_r),
faa_e AS (select *, case when value is null then 'null_line'
    when r2 is null or r3 is null then 'missing_field' when p_ts is null then 'bad_date'
    when r4 is null then 'missing_field' when p_lon is null then 'bad_lon'
    when r5 is null then 'missing_field' when p_lat is null then 'bad_lat'
    when isnan(p_lon) or isnan(p_lat) or isinf(p_lon) or isinf(p_lat) then 'non_finite' end as error
  from faa_p),
faap AS (select event_id, case when error is null then r2 end as tn,
    case when error is null then p_ts end as timestamp, case when error is null then p_lon end as lon,
    case when error is null then p_lat end as lat, error from faa_e)"""


@query("tokenize", O.with_views("""select 'simfile' as format, event_id, cast(pos as integer) as pos, token from (
  select event_id, unnest(range(len(t))) as pos, unnest(t) as token from sfp_t)
union all
select 'faa' as format, event_id, cast(pos as integer) as pos, token from (
  select event_id, unnest(range(len(t))) as pos, unnest(t) as token from faa_t)""", _SF_PARSE, _FAA_PARSE))
def tokenize(spark, sf_dir):
    sf = P.tokens_exploded(T.simfile_lines(spark, sf_dir)).select(F.lit("simfile").alias("format"), "*")
    fa = P.tokens_exploded(T.faa_lines(spark, sf_dir)).select(F.lit("faa").alias("format"), "*")
    return sf.unionByName(fa)


# quoted CSV by pattern: fields that are wholly quoted or hold no quote, to the end of the line
_STRICT_T = """{n}_x AS (select event_id, case when regexp_full_match(value, '("([^"]|"")*"|[^",]*)(,("([^"]|"")*"|[^",]*))*')
    then list_transform(regexp_extract_all(value || ',', '("(?:[^"]|"")*"|[^",]*),', 1),
      lambda t: case when starts_with(t, '"') then replace(substr(t, 2, length(t) - 2), '""', '"') else t end) end as t from {src})"""


@query("strict_tokenize", O.with_views("""select 'simfile' as format, event_id, cast(pos as integer) as pos, token from (
  select event_id, unnest(range(len(t))) as pos, unnest(t) as token from sf_x)
union all
select 'faa' as format, event_id, cast(pos as integer) as pos, token from (
  select event_id, unnest(range(len(t))) as pos, unnest(t) as token from fa_x)""",
    _STRICT_T.format(n="sf", src="simfile_lines"), _STRICT_T.format(n="fa", src="faa_lines")))
def strict_tokenize(spark, sf_dir):
    """PRJ-1 with ``strict``: the lines as quoted CSV."""
    sf = P.tokens_exploded(T.simfile_lines(spark, sf_dir), strict=True).select(F.lit("simfile").alias("format"), "*")
    fa = P.tokens_exploded(T.faa_lines(spark, sf_dir), strict=True).select(F.lit("faa").alias("format"), "*")
    return sf.unionByName(fa)


@query("simfile_parse", O.with_views(
    "select event_id, tm, id, dtg, rt, lon, lat, spd, brg from sfp where error is null", _SF_PARSE))
def simfile_parse(spark, sf_dir):
    return P.simfile_typed(T.simfile_lines(spark, sf_dir)).where("error is null").drop("error")


@query("simfile_split_parse", O.with_views("select * from ssp", _SPLIT_PARSE))
def simfile_split_parse(spark, sf_dir):
    return P.simfile_split_typed(T.simfile_lines(spark, sf_dir))


@query("faa_parse", O.with_views(
    "select event_id, tn, timestamp, lon, lat from faap where error is null", _FAA_PARSE))
def faa_parse(spark, sf_dir):
    return P.faa_typed(T.faa_lines(spark, sf_dir)).where("error is null").drop("error")


@query("parse_errors", O.with_views("""select 'simfile' as format, event_id, error from sfp where error is not null
union all select 'faa' as format, event_id, error from faap where error is not null""", _SF_PARSE, _FAA_PARSE))
def parse_errors(spark, sf_dir):
    sf = (P.simfile_typed(T.simfile_lines(spark, sf_dir)).where("error is not null")
          .select(F.lit("simfile").alias("format"), "event_id", "error"))
    fa = (P.faa_typed(T.faa_lines(spark, sf_dir)).where("error is not null")
          .select(F.lit("faa").alias("format"), "event_id", "error"))
    return sf.unionByName(fa)


def _reparsed(docs: DataFrame, attr_types) -> DataFrame:
    """Read a document column back as JSON and flatten it."""
    d = docs.select("event_id", F.from_json("doc", P.doc_schema(attr_types)).alias("d"))
    return d.select("event_id", *[F.col(f"d.attr.{n}").alias(n) for n, _ in attr_types],
                    F.col("d.geom.x").alias("x"), F.col("d.geom.y").alias("y"),
                    F.col("d.geom.spatialReference.wkid").alias("wkid"), F.col("d.error").alias("error"))


_SF_ATTR_TYPES = [("tm", "bigint"), ("id", "int"), ("dtg", "string"), ("rt", "string"),
                  ("spd", "double"), ("brg", "double")]
_FAA_ATTR_TYPES = [("tn", "string"), ("timestamp", "bigint")]


@query("simfile_to_doc", O.with_views("""select event_id, tm, id, dtg, rt, spd, brg, lon as x, lat as y,
  case when error is null then 4326 end as wkid, error from sfp""", _SF_PARSE))
def simfile_to_doc(spark, sf_dir):
    typed = P.simfile_typed(T.simfile_lines(spark, sf_dir))
    return _reparsed(typed.select("event_id", P.document(typed, P.SIMFILE_ATTRS).alias("doc")),
                     _SF_ATTR_TYPES)


@query("faa_to_doc", O.with_views("""select event_id, tn, timestamp, lon as x, lat as y,
  case when error is null then 4326 end as wkid, error from faap""", _FAA_PARSE))
def faa_to_doc(spark, sf_dir):
    typed = P.faa_typed(T.faa_lines(spark, sf_dir))
    return _reparsed(typed.select("event_id", P.document(typed, P.FAA_ATTRS).alias("doc")),
                     _FAA_ATTR_TYPES)


@query("point_export", O.with_views(
    "select event_id, lon as x, lat as y, 4326 as wkid from sfp where error is null", _SF_PARSE))
def point_export(spark, sf_dir):
    from ..functions.geometry import point_struct
    typed = P.simfile_typed(T.simfile_lines(spark, sf_dir)).where("error is null")
    g = typed.select("event_id", F.to_json(point_struct(F.col("lon"), F.col("lat"))).alias("g"))
    p = g.select("event_id", F.from_json("g", "x double, y double, spatialReference struct<wkid: int>").alias("p"))
    return p.select("event_id", "p.x", "p.y", F.col("p.spatialReference.wkid").alias("wkid"))


# --------------------------------------------------------------------------
# Fences and the point-in-fence join (SRC-6, JOIN-1, JOIN-2, AGG-5, FLT-2)
# --------------------------------------------------------------------------

_FENCE_BOX = """cast(cx - 30 as double) as minx, cast(cy - 30 as double) as miny,
  cast(cx + 30 as double) as maxx, cast(cy + 30 as double) as maxy"""


def _fence_summary(f: DataFrame) -> DataFrame:
    from ..functions.geometry import rings_bbox
    b = rings_bbox(F.col("rings"))
    return f.select("pos", "name", F.size("rings").alias("n_rings"), b.minx.alias("minx"),
                    b.miny.alias("miny"), b.maxx.alias("maxx"), b.maxy.alias("maxy"))


@query("load_fences", O.with_views(
    f"select cast(k as bigint) as pos, name, 1 + k % 2 as n_rings, {_FENCE_BOX} from fences"))
def load_fences(spark, sf_dir):
    path = FS.fence_lines_path(spark, FS.nation_fences(spark, sf_dir))
    good, _errors = G.load_fences(spark, path, FS.FIELD_NAME, multiline=False)
    return _fence_summary(good)


@query("fence_dedupe", O.with_views(f"""select cast(case when f.k % 5 = 0 then 1002 + f.k else f.k end as bigint) as pos,
  f.name, 1 + w.k % 2 as n_rings, {_FENCE_BOX.replace('cx', 'w.cx').replace('cy', 'w.cy')}
from fences f join fences w on w.k = case when f.k % 5 = 0 then f.k + 2 else f.k end"""))
def fence_dedupe(spark, sf_dir):
    fences = FS.with_repeated_names(FS.nation_fences(spark, sf_dir))
    path = FS.fence_lines_path(spark, fences)
    good, _errors = G.load_fences(spark, path, FS.FIELD_NAME, multiline=False)
    return _fence_summary(G.dedupe_fences(good))


_PAIRS = """pairs AS (select p.event_id, f.name from sfp p join fences f
  on abs(p.lon - f.cx) + abs(p.lat - f.cy) < 30
  and not (f.k % 2 = 1 and abs(p.lon - f.cx) + abs(p.lat - f.cy) <= 4)
  where p.error is null),
tags AS (select p.event_id, coalesce(string_agg(q.name, ',' order by q.name), '') as geotag
  from sfp p left join pairs q on p.event_id = q.event_id where p.error is null group by p.event_id)"""


def _valid_points(spark, sf_dir) -> DataFrame:
    return P.simfile_typed(T.simfile_lines(spark, sf_dir)).where("error is null")


@query("point_in_fence_pairs", O.with_views("select event_id, name from pairs", _SF_PARSE, _PAIRS))
def point_in_fence_pairs(spark, sf_dir):
    return G.point_in_fence_pairs(_valid_points(spark, sf_dir), FS.nation_fences(spark, sf_dir), ["event_id"])


@query("geotag", O.with_views("select event_id, geotag from tags", _SF_PARSE, _PAIRS))
def geotag(spark, sf_dir):
    pts = _valid_points(spark, sf_dir).select("event_id", "lon", "lat")
    return G.geotag(pts, FS.nation_fences(spark, sf_dir)).select("event_id", "geotag")


@query("geotag_filtered", O.with_views("select event_id, geotag from tags where geotag <> ''", _SF_PARSE, _PAIRS))
def geotag_filtered(spark, sf_dir):
    return geotag(spark, sf_dir).where(F.col("geotag") != "")


@query("document_geotag", O.with_views("""select p.event_id, coalesce(string_agg(q.name, ',' order by q.name), '') as geotag
from sfp p left join (select s.event_id, f.name from sfp s, fences f, fences w
  where s.error is null and w.k = case when f.k % 5 = 0 then f.k + 2 else f.k end
    and abs(s.lon - w.cx) + abs(s.lat - w.cy) < 30
    and not (w.k % 2 = 1 and abs(s.lon - w.cx) + abs(s.lat - w.cy) <= 4)) q on p.event_id = q.event_id where p.error is null group by p.event_id""", _SF_PARSE))
def document_geotag(spark, sf_dir):
    """SRC-6, JOIN-2 and AGG-5 together: a fence document with repeated names,
    of which the last counts, read and used for tagging."""
    path = FS.fence_document_path(spark, FS.with_repeated_names(FS.nation_fences(spark, sf_dir)))
    good, _errors = G.load_fences(spark, path, FS.FIELD_NAME)
    pts = _valid_points(spark, sf_dir).select("event_id", "lon", "lat")
    return G.geotag(pts, good).select("event_id", "geotag")


# --------------------------------------------------------------------------
# Sampling and batch statistics (FLT-4, SNK-5, AGG-7..10)
# --------------------------------------------------------------------------

_IDX = """li AS (select *, row_number() over (partition by topic, burst order by ms, event_id) - 1 as idx from lb)"""


@query("every_nth", O.with_views(
    f"select topic, event_id, idx from li where idx % {EVERY_NTH} = 0",
    _row_bursts("simfile_lines"), _IDX))
def every_nth(spark, sf_dir):
    lines = T.simfile_lines(spark, sf_dir)
    return B.every_nth(lines, EVERY_NTH, GAP_MS).select("topic", "event_id", "idx")


@query("console_sample", O.with_views(
    f"""select li.event_id, li.idx, coalesce(li.key, 'null') as key, s.tm, s.rt, s.lon as x, s.error
from li join sfp s on s.event_id = li.event_id where li.idx % {EVERY_NTH} = 0""",
    _row_bursts("simfile_lines"), _IDX, _SF_PARSE))
def console_sample(spark, sf_dir):
    """SNK-5: lines are sampled, transformed, and printed if not empty, as
    ``idx>> key:line``; here the printed lines are read back."""
    return _console_back(_console_lines(B.every_nth(T.simfile_lines(spark, sf_dir), EVERY_NTH, GAP_MS)))


def _console_lines(sampled: DataFrame) -> DataFrame:
    out = R.drop_empty(R.apply("simfile", sampled))
    line = F.concat(F.col("idx").cast("string"), F.lit(">> "), F.coalesce(F.col("key"), F.lit("null")), F.lit(":"), F.col("value"))
    return out.select("event_id", line.alias("line"))


def _console_back(printed: DataFrame) -> DataFrame:
    parts = [F.regexp_extract("line", r"^([0-9]+)>> ([^:]*):([\s\S]*)$", i) for i in (1, 2, 3)]
    doc = F.from_json(parts[2], P.doc_schema(_SF_ATTR_TYPES))
    back = printed.select("event_id", parts[0].cast("long").alias("idx"), parts[1].alias("key"), doc.alias("d"))
    return back.select("event_id", "idx", "key", F.col("d.attr.tm").alias("tm"), F.col("d.attr.rt").alias("rt"),
                       F.col("d.geom.x").alias("x"), F.col("d.error").alias("error"))


_RATE_I = f"cast(1000 as double) * count(*) / cast({INTERVAL_MS} as double)"


@query("batch_stats", O.with_views(f"""select (ms // {INTERVAL_MS}) * {INTERVAL_MS} as window_start_ms,
  (ms // {INTERVAL_MS} + 1) * {INTERVAL_MS} as window_end_ms, count(*) as n, {_RATE_I} as rate
from latency_lines group by ms // {INTERVAL_MS}"""))
def batch_stats(spark, sf_dir):
    return BA.batch_stats(T.latency_lines(spark, sf_dir), INTERVAL_MS)


_BATCH_RUNS = f"""bw AS (select ms // {INTERVAL_MS} as w, count(*) as n from latency_lines group by 1),
bi AS (select *, w - row_number() over (order by w) as run from bw)"""


@query("run_stats", O.with_views(f"""select min(w) * {INTERVAL_MS} as start_ms, (max(w) + 1) * {INTERVAL_MS} as end_ms,
  cast(sum(n) as bigint) as n, count(*) as batches,
  cast(1000 as double) * cast(sum(n) as double) / cast(count(*) * {INTERVAL_MS} as double) as avg_rate
from bi group by run having max(w) < (select max(w) from bw)""", _BATCH_RUNS))
def run_stats(spark, sf_dir):
    return BA.run_stats(T.latency_lines(spark, sf_dir), INTERVAL_MS)


@query("microbatch_burst", O.with_views(f"""select (min(w) + 1) * {INTERVAL_MS} as start_ms, (max(w) + 1) * {INTERVAL_MS} as end_ms,
  cast(sum(n) as bigint) as n,
  case when max(w) > min(w) then cast(1000 as double) * cast(sum(n) as double)
       / cast((max(w) - min(w)) * {INTERVAL_MS} as double) end as rate
from bi group by run having max(w) < (select max(w) from bw)""", _BATCH_RUNS))
def microbatch_burst(spark, sf_dir):
    return BA.microbatch_burst(T.latency_lines(spark, sf_dir), INTERVAL_MS)


@query("running_burst_count", O.with_views(f"""select topic, (w + 1) * {INTERVAL_MS} as batch_ms, n,
  cast(sum(n) over (partition by topic, burst order by w rows unbounded preceding) as bigint) as running_n
from (select *, sum(s) over (partition by topic order by w rows unbounded preceding) as burst
  from (select *, case when lag(w) over (partition by topic order by w) is null
          or (w - lag(w) over (partition by topic order by w)) * {INTERVAL_MS} > {GAP_MS} then 1 else 0 end as s from tw))
union all
select topic, reset as batch_ms, cast(0 as bigint) as n, cast(0 as bigint) as running_n
from (select topic, (w + 1) * {INTERVAL_MS} as at,
        (select min(b.i + 1) * {INTERVAL_MS} from range(0, {GAP_MS // INTERVAL_MS + 3}) r(j), lateral (select tw.w + j as i) b
         where (b.i + 1) * {INTERVAL_MS} - (tw.w + 1) * {INTERVAL_MS} > {GAP_MS}) as reset,
        (lead(w) over (partition by topic order by w) + 1) * {INTERVAL_MS} as following from tw)
where case when following is null then reset <= (select (max(w) + 1) * {INTERVAL_MS} from tw) else reset < following end""",
    f"tw AS (select topic, ms // {INTERVAL_MS} as w, count(*) as n from latency_lines group by all)"))
def running_burst_count(spark, sf_dir):
    return BA.running_burst_count(T.latency_lines(spark, sf_dir), INTERVAL_MS, GAP_MS)


# --------------------------------------------------------------------------
# Sources (SRC-1..5)
# --------------------------------------------------------------------------

STREAM_CHUNKS = 5
SUBSCRIPTION = ["click", "view"]
PREVIEW_LINES = 1000


#: A replay is in arrival order from one micro-batch to the next.
NO_DELAY = "0 seconds"


def _line_stream(spark, lines: DataFrame) -> DataFrame:
    """A line view replayed as a stream of time-ordered files."""
    path, each = RUN.write_stream_files(lines, "ms", STREAM_CHUNKS)
    return RUN.file_stream(spark, path, lines.schema, each)


@query("line_source", O.with_views(
    "select topic, partition_id as partition, event_id as offset, key, value from simfile_lines"))
def line_source(spark, sf_dir):
    """SRC-1 / PRJ-7: every record of every topic, through a stream."""
    st = _line_stream(spark, T.simfile_lines(spark, sf_dir))
    rec = K.lines_as_records(st).select("topic", "partition", "offset", "key", "value")
    return RUN.run_to_files(rec, "line-source")


@query("multi_topic_source", O.with_views(
    "select topic, partition_id as partition, event_id as offset, key, value from simfile_lines "
    f"where topic in ({', '.join(repr(t) for t in SUBSCRIPTION)})"))
def multi_topic_source(spark, sf_dir):
    """SRC-2: a comma-separated topic list."""
    st = _line_stream(spark, T.simfile_lines(spark, sf_dir))
    rec = K.subscribe(K.lines_as_records(st), ",".join(SUBSCRIPTION))
    return RUN.run_to_files(rec.select("topic", "partition", "offset", "key", "value"), "multi-topic")


@query("bounded_partition_count", O.with_views(
    "select topic, count(*) as n from latency_lines where partition_id = 0 group by topic"))
def bounded_partition_count(spark, sf_dir):
    """SRC-3 + AGG-6: a bounded read of partition 0, counted."""
    rec = K.lines_as_records(T.latency_lines(spark, sf_dir))
    return rec.where(F.col("partition") == 0).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("key_value_dump", O.with_views(
    "select event_id, concat(coalesce(key, 'null'), ':', value) as line from simfile_lines"))
def key_value_dump(spark, sf_dir):
    """SRC-4: ``key:value`` for every record."""
    rec = T.simfile_lines(spark, sf_dir)
    return rec.select("event_id", F.concat(F.coalesce("key", F.lit("null")), F.lit(":"), "value").alias("line"))


@query("file_preview", O.with_views(f"""select f.value as line, t.geotag, s.error from
  (select event_id, value from simfile_lines order by event_id limit {PREVIEW_LINES}) f
  join sfp s on s.event_id = f.event_id left join tags t on t.event_id = f.event_id
where s.error is not null or t.geotag <> ''""", _SF_PARSE, _PAIRS))
def file_preview(spark, sf_dir):
    """SRC-5 + LIM-1: a text file of lines; the first 1,000 input lines (the
    limit comes before the transform) go through the geotag transform and
    lines with non-empty output are shown with their output."""
    path = fresh_path(spark, "preview")
    # the lines as text, in event order over range-partitioned part files
    T.simfile_lines(spark, sf_dir).orderBy("event_id").select("value").write.text(path)
    first = TX.first_lines(spark, path, PREVIEW_LINES)
    first = first.withColumn("line", F.col("value"))
    typed = P.simfile_typed(first, keep=["line"])
    tagged = G.geotag(typed, FS.nation_fences(spark, sf_dir), row_key="line")
    shown = tagged.where(F.col("error").isNotNull() | (F.col("geotag") != ""))
    return shown.select("line", F.when(F.col("error").isNull(), F.col("geotag")).alias("geotag"), "error")


# --------------------------------------------------------------------------
# Transforms, forwarding and index sinks (UDF-1, PRJ-8, SNK-1..4, FLT-1)
# --------------------------------------------------------------------------

@query("noop_transform", O.with_views("select event_id, 'NOOP' as name, value from simfile_lines"))
def noop_transform(spark, sf_dir):
    out = R.apply("NOOP", T.simfile_lines(spark, sf_dir))
    return out.select("event_id", F.lit("NOOP").alias("name"), "value")


@query("transform_registry", O.with_views("""select l.event_id, 'noop' as name, 'line' as status, cast(null as bigint) as tm
  from simfile_lines l
union all
select event_id, 'SimFile' as name, case when error is null then 'doc' else 'error' end as status, tm from sfp""", _SF_PARSE))
def transform_registry(spark, sf_dir):
    """Two transforms picked by name (case ignored), results side by side."""
    lines = T.simfile_lines(spark, sf_dir).select("event_id", "value")
    outs = []
    for name in ["noop", "SimFile"]:
        o = R.apply(name, lines)
        is_doc = F.col("value").startswith('{"attr"')
        status = (F.when(F.lit(name.lower() == "noop"), F.lit("line"))
                  .when(is_doc, F.lit("doc")).otherwise(F.lit("error")))
        tm = F.when(F.lit(name.lower() != "noop") & is_doc,
                    F.get_json_object("value", "$.attr.tm").cast("long"))
        outs.append(o.select("event_id", F.lit(name).alias("name"), status.alias("status"), tm.alias("tm")))
    return outs[0].unionByName(outs[1])


@query("transform_by_path", O.with_views("""select event_id, replace(replace(replace(replace(replace(value,
  '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;') as value from simfile_lines"""))
def transform_by_path(spark, sf_dir):
    """UDF-1: a plain function of a line, loaded by its path and run in Arrow batches."""
    return R.apply("html.escape", T.simfile_lines(spark, sf_dir)).select("event_id", "value")


_FORWARD_SCHEMA = ("attr struct<tm: bigint, id: int, dtg: string, rt: string, spd: double, brg: double, "
                   "geotag: string>, error string")


@query("transform_forward", O.with_views("""select l.event_id, l.key, s.tm, t.geotag, s.error
from simfile_lines l join sfp s on s.event_id = l.event_id left join tags t on t.event_id = l.event_id
where s.error is not null or t.geotag <> ''""", _SF_PARSE, _PAIRS))
def transform_forward(spark, sf_dir):
    """SNK-1: geotag transform with filter, empties dropped, input key kept,
    written to the topic stand-in and read back."""
    rec = K.lines_as_records(T.simfile_lines(spark, sf_dir))
    out = R.drop_empty(R.apply("geotag", rec, fences=FS.nation_fences(spark, sf_dir), filter=True,
                               row_key="offset"))
    path = W.kafka_stand_in_write(out.select("key", "value", "topic", "partition", "offset"),
                                  fresh_path(spark, "topic-out"))
    return _forwarded(spark.read.parquet(path))


def _forwarded(back: DataFrame) -> DataFrame:
    d = back.select("offset", "key", F.from_json("value", _FORWARD_SCHEMA).alias("d"))
    return d.select(F.col("offset").alias("event_id"), "key", F.col("d.attr.tm").alias("tm"),
                    F.col("d.attr.geotag").alias("geotag"), F.col("d.error").alias("error"))


_SOURCE_SCHEMA = ("attr: struct<tm: bigint, id: int, dtg: string, rt: string, spd: double, brg: double>, "
                  "geom: struct<x: double, y: double, spatialReference: struct<wkid: int>>, error: string")
_INDEX_ORACLE = O.with_views("""select concat_ws('-', l.topic, cast(l.partition_id as varchar), cast(l.event_id as varchar)) as doc_id,
  s.tm, s.id, s.rt, s.lon as x, s.lat as y, s.error
from simfile_lines l join sfp s on s.event_id = l.event_id""", _SF_PARSE)


def _index_back(spark, path) -> DataFrame:
    b = W.index_read(spark, path, _SOURCE_SCHEMA)
    return b.select(F.col("_id").alias("doc_id"), F.col("_source.attr.tm").alias("tm"),
                    F.col("_source.attr.id").alias("id"), F.col("_source.attr.rt").alias("rt"),
                    F.col("_source.geom.x").alias("x"), F.col("_source.geom.y").alias("y"),
                    F.col("_source.error").alias("error"))


@query("index_json_bulk", _INDEX_ORACLE)
def index_json_bulk(spark, sf_dir):
    """SNK-2: JSON documents into the bulk index layout, read back."""
    rec = K.lines_as_records(T.simfile_lines(spark, sf_dir))
    docs = R.apply("simfile", rec).select(W.doc_id().alias("doc_id"), F.col("value").alias("doc"))
    path = W.index_write(docs, fresh_path(spark, "index"), "simulator", "simfile")
    return _index_back(spark, path)


#: Documents of a bulk request.
ACTIONS = 1000


@query("index_bulk_requests", _INDEX_ORACLE)
def index_bulk_requests(spark, sf_dir):
    """SNK-2 through the bulk data source: requests of ACTIONS documents, two runs into one
    index (the documents of even offsets, then all), read back."""
    rec = K.lines_as_records(T.simfile_lines(spark, sf_dir))
    root = fresh_path(spark, "index-bulk")
    for some in (rec.where("offset % 2 = 0"), rec):
        docs = R.apply("simfile", some).select(W.doc_id().alias("doc_id"), F.col("value").alias("doc"))
        path = IX.bulk_write(W.bulk_lines(docs), root, "simulator", "simfile", ACTIONS)
    return _index_back(spark, path)


@query("stream_index_bulk", _INDEX_ORACLE)
def stream_index_bulk(spark, sf_dir):
    """SNK-2 on a stream: every epoch's bulk requests become visible with its commit."""
    st = K.lines_as_records(_line_stream(spark, T.simfile_lines(spark, sf_dir)))
    docs = R.apply("simfile", st).select(W.doc_id().alias("doc_id"), F.col("value").alias("doc"))
    root = fresh_path(spark, "index-bulk-stream")
    RUN.run_writer(IX.bulk_stream(W.bulk_lines(docs), root, "simulator", "simfile", "replay", ACTIONS), spark, "index-bulk-stream")
    return _index_back(spark, f"{root}/index=simulator/type=simfile")


@query("index_json_microbatch", _INDEX_ORACLE)
def index_json_microbatch(spark, sf_dir):
    """SNK-3: the same writer called once per micro-batch of a stream."""
    st = K.lines_as_records(_line_stream(spark, T.simfile_lines(spark, sf_dir)))
    root = fresh_path(spark, "index-mb")

    def each(batch: DataFrame, batch_id: int):
        # one folder per batch id, overwritten on replay: a batch re-run after
        # a failure replaces its own output instead of adding duplicates
        docs = R.apply("simfile", batch).select(W.doc_id().alias("doc_id"), F.col("value").alias("doc"))
        W.index_write(docs, root, "simulator", "simfile", batch_id=batch_id)

    RUN.run_foreach_batch(st, "index-mb", each)
    return _index_back(spark, f"{root}/index=simulator/type=simfile")


@query("index_csv_typed", O.with_views("""select concat_ws('-', l.topic, cast(l.partition_id as varchar), cast(l.event_id as varchar)) as doc_id,
  s.tm, s.id, s.dtg, s.rt, s.lon, s.lat, s.speed, s.bearing
from simfile_lines l join ssp s on s.event_id = l.event_id where s.error is null""", _SPLIT_PARSE))
def index_csv_typed(spark, sf_dir):
    """SNK-4: plain-split typed records as documents; bad rows go to a
    dead-letter layout instead of failing the batch."""
    rec = K.lines_as_records(T.simfile_lines(spark, sf_dir))
    typed = P.simfile_split_typed(rec, keep=["topic", "partition", "offset"])
    fields = [n for n, _ in P.SPLIT_FIELDS]
    root = fresh_path(spark, "index-csv")
    ok = F.col("error").isNull()
    docs = typed.select(W.doc_id().alias("doc_id"),
                        F.when(ok, F.to_json(F.struct(*fields))).otherwise(F.to_json(F.struct("error"))).alias("doc"),
                        F.when(ok, F.lit("simfile")).otherwise(F.lit("simfile_errors")).alias("type"))
    path = W.index_write(docs, root, "sink", None) + "/type=simfile"
    schema = ", ".join(f"{n}: {t}" for n, t in [("tm", "bigint"), ("id", "string"), ("dtg", "string"),
                                                  ("rt", "string"), ("lon", "double"), ("lat", "double"),
                                                  ("speed", "double"), ("bearing", "double")])
    b = W.index_read(spark, path, schema)
    return b.select(F.col("_id").alias("doc_id"), *[F.col(f"_source.{n}").alias(n) for n in fields])


# --------------------------------------------------------------------------
# Metrics table and history (SNK-6, AGG-11)
# --------------------------------------------------------------------------

_METRICS_SQL = f"""ml AS (select topic, max(ms) + {GAP_MS} as closed_ms, count(*) as count, {_RATE_SQL} as rate,
  cast(coalesce(sum(case when ok then ms - sent end), 0) as double) / cast(count(*) as double) as latency
from lf group by topic, burst having max(ms) + {GAP_MS} <= (select max(ms) from latency_lines))"""


def _metrics_table(spark, sf_dir) -> DataFrame:
    lines = T.latency_lines(spark, sf_dir)
    bursts = B.closed_by_arrivals(B.burst_latency(lines, GAP_MS), GAP_MS)
    return W.metrics_read(spark, W.metrics_write(bursts, fresh_path(spark, "metrics")))


@query("burst_metrics_table", O.with_views("select * from ml", _ROW_BURSTS_LATENCY, _LATENCY_ROWS, _METRICS_SQL))
def burst_metrics_table(spark, sf_dir):
    return _metrics_table(spark, sf_dir)


@query("metrics_history", O.with_views("""select topic,
  row_number() over (partition by topic order by closed_ms) - 1 as position, closed_ms, count, rate, latency
from ml""", _ROW_BURSTS_LATENCY, _LATENCY_ROWS, _METRICS_SQL))
def metrics_history(spark, sf_dir):
    """AGG-11: the history of each topic in close order, one row an entry."""
    return _history(_metrics_table(spark, sf_dir)).drop("last_closed_ms")


#: Entries of the history that one task orders.
ENTRIES_EACH = 100_000


def _history(metrics: DataFrame) -> DataFrame:
    metrics = materialize(metrics)
    m = with_sequence(metrics, ["closed_ms"], "position", ["topic"], slices=1 + metrics.count() // ENTRIES_EACH)
    last = metrics.groupBy(F.col("topic").alias("_t")).agg(F.max("closed_ms").alias("last_closed_ms"))  # a row a topic
    m = m.join(last, F.col("topic").eqNullSafe(F.col("_t")))
    return m.select("topic", "position", "closed_ms", "count", "rate", "latency", "last_closed_ms")


# --------------------------------------------------------------------------
# Streams (STR-2, STR-3, STR-6, STR-7)
# --------------------------------------------------------------------------

@query("stream_transform", ORACLES["simfile_to_doc"])
def stream_transform(spark, sf_dir):
    st = _line_stream(spark, T.simfile_lines(spark, sf_dir))
    out = RUN.run_to_files(S.stream_documents(st), "stream-transform")
    return _reparsed(out, _SF_ATTR_TYPES)


@query("stream_geotag", ORACLES["geotag"])
def stream_geotag(spark, sf_dir):
    st = _line_stream(spark, T.simfile_lines(spark, sf_dir))
    return RUN.run_to_files(S.stream_geotag(st, FS.nation_fences(spark, sf_dir)), "stream-geotag")


@query("stream_burst_count", O.with_views(
    "select topic, min(ms) as start_ms, max(ms) as end_ms, count(*) as n from lb group by topic, burst "
    f"having max(ms) + {GAP_MS} <= (select max(ms) from latency_lines)", _ROW_BURSTS_LATENCY))
def stream_burst_count(spark, sf_dir):
    st = _line_stream(spark, T.latency_lines(spark, sf_dir).select("event_id", "ms", "topic"))
    return RUN.run_to_files(S.stream_bursts(st, GAP_MS, NO_DELAY), "stream-bursts")


@query("stream_batch_stats", O.with_views(f"""select (ms // {INTERVAL_MS}) * {INTERVAL_MS} as window_start_ms,
  (ms // {INTERVAL_MS} + 1) * {INTERVAL_MS} as window_end_ms, count(*) as n, {_RATE_I} as rate
from latency_lines group by ms // {INTERVAL_MS}
having (ms // {INTERVAL_MS} + 1) * {INTERVAL_MS} <= (select max(ms) from latency_lines)"""))
def stream_batch_stats(spark, sf_dir):
    st = _line_stream(spark, T.latency_lines(spark, sf_dir).select("event_id", "ms"))
    return RUN.run_to_files(S.stream_batch_stats(st, INTERVAL_MS, NO_DELAY), "stream-batches")


@query("stream_burst_latency", O.with_views(f"""select topic, min(ms) as start_ms, max(ms) as end_ms, count(*) as n, {_RATE_SQL} as rate,
  cast(coalesce(sum(case when ok then ms - sent end), 0) as double) / cast(count(*) as double) as avg_latency
from lf group by topic, burst having max(ms) + {GAP_MS} <= (select max(ms) from latency_lines)""", _ROW_BURSTS_LATENCY, _LATENCY_ROWS))
def stream_burst_latency(spark, sf_dir):
    """AGG-2..4 live: the records are stored batch by batch, the closed bursts
    are taken from the store."""
    lines = T.latency_lines(spark, sf_dir).select("event_id", "ms", "topic", "value")
    store = fresh_path(spark, "burst-rows")
    RUN.run_foreach_batch(_line_stream(spark, lines), "burst-rows", S.keep_lines(store))
    return S.closed_burst_latency(spark, store, GAP_MS).drop("valid_n", "closed_ms")


#: Silence of the wall clock that ends a burst in a replay, triggers, and empty ones that end the run.
IDLE_MS, TRIGGER_MS, EMPTY_POLLS = 1000, 250, 10


@query("stream_burst_close", ORACLES["burst_latency"])
def stream_burst_close(spark, sf_dir):
    """STR-2 with AGG-2..4: every burst with count, rate and average latency, the
    last one of each topic too: closed by the wall clock when the input stops."""
    lines = T.latency_lines(spark, sf_dir).select("event_id", "ms", "topic", "value")
    with L.rocksdb_state(spark):
        return RUN.run_until_idle(L.closed_bursts(_line_stream(spark, lines), GAP_MS, IDLE_MS), "burst-close", TRIGGER_MS, EMPTY_POLLS)


@query("stream_metrics_history", O.with_views(f"""select topic, row_number() over (partition by topic order by max(ms)) - 1 as position,
  max(ms) + {GAP_MS} as closed_ms, count(*) as count, {_RATE_SQL} as rate,
  cast(coalesce(sum(case when ok then ms - sent end), 0) as double) / cast(count(*) as double) as latency,
  max(max(ms) + {GAP_MS}) over (partition by topic) as last_closed_ms
from lf group by topic, burst""", _ROW_BURSTS_LATENCY, _LATENCY_ROWS))
def stream_metrics_history(spark, sf_dir):
    """SNK-6 and AGG-11 live: each epoch's closed bursts as its entry of the ledger, the
    ledger compacted, the history with its last close time read back."""
    lines = T.latency_lines(spark, sf_dir).select("event_id", "ms", "topic", "value")
    ledger = fresh_path(spark, "ledger")
    with L.rocksdb_state(spark):
        bursts = L.closed_bursts(_line_stream(spark, lines), GAP_MS, IDLE_MS)
        RUN.run_writer_until_idle(bursts.writeStream.foreachBatch(S.keep_metrics(ledger, "bursts", GAP_MS)), spark, "ledger", TRIGGER_MS, EMPTY_POLLS)
    W.metrics_compact(spark, ledger)
    return _history(W.metrics_read(spark, ledger))


@query("stream_bounded_count", ORACLES["bounded_partition_count"])
def stream_bounded_count(spark, sf_dir):
    """SRC-3 + AGG-6: a continuous read of partition 0 that ends after ten empty polls, counted."""
    rec = K.lines_as_records(_line_stream(spark, T.latency_lines(spark, sf_dir))).where("partition = 0").select("topic", "offset")
    return RUN.run_until_idle(rec, "bounded-read", TRIGGER_MS, EMPTY_POLLS).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("stream_every_nth", ORACLES["every_nth"])
def stream_every_nth(spark, sf_dir):
    """FLT-4 live: positions go on from one micro-batch to the next."""
    folder = fresh_path(spark, "every-nth")
    st = _line_stream(spark, T.simfile_lines(spark, sf_dir).select("event_id", "ms", "topic"))
    RUN.run_foreach_batch(st, "every-nth", PO.every_nth(EVERY_NTH, GAP_MS, folder))
    return PO.read(spark, folder).select("topic", "event_id", "idx")


@query("stream_console_sample", ORACLES["console_sample"])
def stream_console_sample(spark, sf_dir):
    """SNK-5 live: the sampled lines of each micro-batch transformed and printed, read back."""
    folder = fresh_path(spark, "console")
    st = _line_stream(spark, T.simfile_lines(spark, sf_dir))
    RUN.run_foreach_batch(st, "console", PO.every_nth(EVERY_NTH, GAP_MS, folder, _console_lines))
    return _console_back(PO.read(spark, folder))


DAY_MS = 86_400_000


@query("stream_batch_progress", O.with_views(f"""select row_number() over (order by ms // {DAY_MS}) - 1 as batch,
  count(*) as records, cast(0 as bigint) as late_rows from latency_lines group by ms // {DAY_MS}"""))
def stream_batch_progress(spark, sf_dir):
    """AGG-7 live, STR-1: a replay with a day's arrivals in each micro-batch; what
    the listener has written of each batch."""
    lines = T.latency_lines(spark, sf_dir).select("event_id", "ms", "topic", F.expr(f"ms div {DAY_MS}").alias("day"))
    st = RUN.file_stream(spark, RUN.write_stream_slices(lines, "day"), lines.schema)
    _out, log = RUN.run_logged(S.stream_batch_stats(st, INTERVAL_MS, NO_DELAY), "batch-progress")
    return log.read().select("batch", "records", "late_rows")


@query("stream_forward", ORACLES["transform_forward"])
def stream_forward(spark, sf_dir):
    """STR-6 + SNK-1: a transform picked by name between a source and a topic."""
    st = K.lines_as_records(_line_stream(spark, T.simfile_lines(spark, sf_dir)))
    out = S.stream_forward(st, "geotag", fences=FS.nation_fences(spark, sf_dir), filter=True, row_key="offset")
    back = RUN.run_to_files(out.select("key", "value", "topic", "partition", "offset"), "stream-forward")
    return _forwarded(back)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse simFile records → typed columns → point-in-fence join → tag →
    JSON document (errors as error documents), key kept."""
    rec = K.lines_as_records(T.simfile_lines(spark, sf_dir))
    out = R.apply("geotag", rec, fences=FS.nation_fences(spark, sf_dir), filter=False, row_key="offset")
    return out.select(F.col("offset").alias("event_id"), "key", "value")
