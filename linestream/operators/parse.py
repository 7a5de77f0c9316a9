"""Line parsers (PRJ-1..6, FLT-3): text lines → typed columns + error reason.

Every parser is a pure projection (no shuffle), so it runs the same in batch
and on a stream, pipelined in one whole-stage-codegen span after the scan.
A row that fails gets a reason code in ``error`` and NULL typed columns
(FLT-3); the checks run in the field order of the original parsers so the
first failing field names the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.geometry import point_struct

# Reason codes of the error column.
R_NULL_LINE = "null_line"
R_MISSING = "missing_field"
R_NON_FINITE = "non_finite"
R_BAD_DATE = "bad_date"
R_BAD_QUOTES = "bad_quotes"

# simFile layout (positions 0-7) and the kind of parse each field needs.
SIMFILE_FIELDS = [("tm", "long"), ("id", "int"), ("dtg", "string"), ("rt", "string"),
                  ("lon", "double"), ("lat", "double"), ("spd", "double"), ("brg", "double")]
# Plain-split variant: id stays text and two fields have longer names.
SPLIT_FIELDS = [("tm", "long"), ("id", "string"), ("dtg", "string"), ("rt", "string"),
                ("lon", "double"), ("lat", "double"), ("speed", "double"), ("bearing", "double")]


def _typed(raw: Column, kind: str) -> Column:
    if kind == "long":
        return X.strict_long(raw)
    if kind == "int":
        return X.strict_int(raw)
    if kind == "double":
        return X.to_double(raw)
    return raw


def _parse_fields(df: DataFrame, tokens: Column, fields, keep: list[str],
                  finite: list[str], uncut: str | None = None) -> DataFrame:
    """Typed columns + ``error`` from an array of tokens.

    Three projections: raw tokens, then each field parsed once, then the
    reason; the optimizer keeps them apart because the parsed values are
    referenced many times, so nothing is evaluated twice per row."""
    n = len(fields)
    none = [F.col("_t").isNull().alias("_none")] if uncut else []
    raw = df.select(*keep, F.col("value"), tokens.alias("_t")).select(
        *keep, F.col("value"), *none, *[X.token(F.col("_t"), i).alias(f"_r{i}") for i in range(n)])
    parsed = raw.select(*keep, F.col("value"), *(["_none"] if uncut else []), *[F.col(f"_r{i}") for i in range(n)],
                        *[_typed(F.col(f"_r{i}"), kind).alias(f"_p{i}")
                          for i, (_, kind) in enumerate(fields)])
    reason = F.when(F.col("value").isNull(), F.lit(R_NULL_LINE))
    if uncut:  # no tokens at all: the reason the tokenizer has
        reason = reason.when(F.col("_none"), F.lit(uncut))
    for i, (name, kind) in enumerate(fields):
        reason = reason.when(F.col(f"_r{i}").isNull(), F.lit(R_MISSING))
        if kind != "string":
            reason = reason.when(F.col(f"_p{i}").isNull(), F.lit(f"bad_{name}"))
    names = [nm for nm, _ in fields]
    for name in finite:
        v = F.col(f"_p{names.index(name)}")
        reason = reason.when(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(R_NON_FINITE))
    judged = parsed.select(*keep, *[F.col(f"_p{i}") for i in range(n)], reason.alias("error"))
    ok = F.col("error").isNull()
    return _emit(judged, keep, [*[F.when(ok, F.col(f"_p{i}")).alias(name) for i, name in enumerate(names)],
                                F.col("error")])


def _emit(df: DataFrame, keep: list[str], parsed: list[Column]) -> DataFrame:
    """Emit the parsed values through a generator (one row in, one row out).

    A later filter on ``error`` (or on a parsed value) then stays above the
    parse: the optimizer does not push predicates on generator output below
    the generator, so it cannot copy the whole parse expression into a
    filter next to the scan and evaluate it twice per row. Filters on the kept
    columns, which the generator does not make, do go down to the scan."""
    return df.select(*keep, F.inline(F.array(F.struct(*parsed))))


def tokens_exploded(lines: DataFrame, keep: list[str] | None = None, strict: bool = False) -> DataFrame:
    """PRJ-1 as rows: ``keep..., pos, token`` (0-based positions); with ``strict``
    by the rules of quoted CSV (`functions.text.strict_csv`), lines with bad quotes left out."""
    keep = keep or ["event_id"]
    tokens = (X.strict_csv if strict else X.tokenize)(F.col("value"))
    return lines.select(*keep, F.posexplode(tokens).alias("pos", "token"))


def simfile_typed(lines: DataFrame, keep: list[str] | None = None, strict: bool = False) -> DataFrame:
    """PRJ-2: quote-aware tokens → tm long, id int, dtg, rt, lon, lat, spd, brg;
    with ``strict`` the line is quoted CSV and bad quotes are an error."""
    keep = keep or ["event_id"]
    if strict:
        return _parse_fields(lines, X.strict_csv(F.col("value")), SIMFILE_FIELDS, keep, ["lon", "lat", "spd", "brg"], R_BAD_QUOTES)
    return _parse_fields(lines, X.tokenize(F.col("value")), SIMFILE_FIELDS, keep,
                         ["lon", "lat", "spd", "brg"])


def simfile_split_typed(lines: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """PRJ-3: plain comma split (not quote-aware), id kept as text.
    Trailing empty fields are dropped before splitting, as a plain string
    split does."""
    keep = keep or ["event_id"]
    parts = F.split(F.regexp_replace(F.col("value"), ",+$", ""), ",")
    return _parse_fields(lines, parts, SPLIT_FIELDS, keep, ["lon", "lat", "speed", "bearing"])


def parse_mdy_ms(s: Column, zone: str = "UTC", honor_marker: bool = False) -> Column:
    """``MM/dd/yyyy hh:mm:ss AM`` → epoch ms.

    Default parity rule: the hour is read as a 24-hour field and the AM/PM
    marker is ignored (``12:02:00 AM`` → 12:02). ``honor_marker=True`` reads a
    real 12-hour clock. Strict: text that is not such a date gives NULL.
    """
    shape = s.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2}( [AaPp][Mm])?\z")
    if honor_marker:
        ts = F.try_to_timestamp(s, F.lit("MM/dd/yyyy hh:mm:ss a"))
    else:
        ts = F.try_to_timestamp(F.substring(s, 1, 19), F.lit("MM/dd/yyyy HH:mm:ss"))
    if zone != "UTC":
        ts = F.to_utc_timestamp(ts, zone)
    return F.when(shape, F.unix_millis(ts))


def faa_typed(lines: DataFrame, keep: list[str] | None = None, zone: str = "UTC",
              honor_marker: bool = False) -> DataFrame:
    """PRJ-4: aircraft line → tn (field 2), timestamp ms (field 3), lon, lat."""
    keep = keep or ["event_id"]
    tok = lines.select(*keep, F.col("value"), X.tokenize(F.col("value")).alias("_t"))
    raw = {i: X.token(F.col("_t"), i) for i in range(6)}
    stamp = parse_mdy_ms(raw[3], zone, honor_marker)
    lon, lat = X.to_double(raw[4]), X.to_double(raw[5])
    reason = (F.when(F.col("value").isNull(), F.lit(R_NULL_LINE))
              .when(raw[2].isNull() | raw[3].isNull(), F.lit(R_MISSING))
              .when(stamp.isNull(), F.lit(R_BAD_DATE))
              .when(raw[4].isNull(), F.lit(R_MISSING))
              .when(lon.isNull(), F.lit("bad_lon"))
              .when(raw[5].isNull(), F.lit(R_MISSING))
              .when(lat.isNull(), F.lit("bad_lat"))
              .when(F.isnan(lon) | F.isnan(lat) | (F.abs(lon) == float("inf"))
                    | (F.abs(lat) == float("inf")), F.lit(R_NON_FINITE)))
    parsed = tok.select(*keep, raw[2].alias("_tn"), stamp.alias("_ts"), lon.alias("_lon"),
                        lat.alias("_lat"), reason.alias("error"))
    ok = F.col("error").isNull()
    return _emit(parsed, keep, [F.when(ok, F.col("_tn")).alias("tn"), F.when(ok, F.col("_ts")).alias("timestamp"),
                                F.when(ok, F.col("_lon")).alias("lon"), F.when(ok, F.col("_lat")).alias("lat"),
                                F.col("error")])


# --------------------------------------------------------------------------
# Documents (PRJ-5, PRJ-6)
# --------------------------------------------------------------------------

SIMFILE_ATTRS = ["tm", "id", "dtg", "rt", "spd", "brg"]
FAA_ATTRS = ["tn", "timestamp"]


def document(df: DataFrame, attrs: list[str]) -> Column:
    """``{"attr": {...}, "geom": {x, y, spatialReference}}`` as JSON text,
    or ``{"error": reason}`` for a failed row (valid JSON, unlike the
    original's unterminated error text)."""
    doc = F.to_json(F.struct(F.struct(*[F.col(a) for a in attrs]).alias("attr"),
                             point_struct(F.col("lon"), F.col("lat")).alias("geom")))
    err = F.to_json(F.struct(F.col("error").alias("error")))
    return F.when(F.col("error").isNull(), doc).otherwise(err)


def doc_schema(attr_types: list[tuple[str, str]]) -> str:
    attrs = ", ".join(f"{n}: {t}" for n, t in attr_types)
    return (f"attr struct<{attrs}>, geom struct<x: double, y: double, "
            "spatialReference: struct<wkid: int>>, error string")
