"""Column expressions for line text: tokenizing and strict number parsing.

All of them are built-in Spark expressions (JVM side, whole-stage codegen);
no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# Quote-aware token pattern: an unquoted token (first char not a quote, up to
# the next comma) or a quoted token, each optionally followed by one comma.
TOKEN_PATTERN = '(([^"][^,]*)|"([^"]*)"),?'
# Integer text accepted by a strict integer parse: optional sign, digits only.
INTEGER_PATTERN = "^[+-]?[0-9]+\\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(line) -> Column:
    """Tokens of a line, quotes removed: ``array<string>``.

    Group 1 of every match is the whole token; a token that starts with a
    quote is the quoted alternative, so its outer quotes are cut.
    """
    line = _col(line)
    raw = F.regexp_extract_all(line, F.lit(TOKEN_PATTERN), 1)
    unquote = F.transform(
        raw, lambda t: F.when(t.startswith('"'), t.substr(F.lit(2), F.length(t) - 2)).otherwise(t))
    # exact fast path: a line without a quote has no quoted token, and the
    # per-element lambda (interpreted, not code-generated) can be skipped
    return F.when(line.contains('"'), unquote).otherwise(raw)


#: Stand in for a comma outside quotes, and for the first character of that, while a line is cut.
_CUT, _ESCAPE = "\x01,", "\x01"


def strict_csv(line) -> Column:
    """Fields of a quoted CSV line: ``array<string>``; NULL if a quote is left open
    or stands anywhere but around a field or doubled inside one.

    Whether a comma separates follows from the quotes before it: each one turns
    the state, and a doubled quote turns it twice. The pieces between quotes
    are folded with that state; only commas in pieces outside quotes cut. Empty
    fields are kept (``a,,b`` has three), a doubled quote is one quote."""
    line = _col(line)
    pieces = F.split(F.replace(line, F.lit(_ESCAPE), F.lit(_ESCAPE + "e")), '"', -1)
    marked = F.array_join(F.transform(pieces, lambda p, i: F.when(i % 2 == 0, F.replace(p, F.lit(","), F.lit(_CUT))).otherwise(p)), '"')
    raw = F.split(marked, _CUT, -1)
    whole = F.forall(raw, lambda t: ~t.contains('"') | t.rlike('^"([^"]|"")*"\\z'))
    fields = F.transform(raw, lambda t: F.replace(
        F.when(t.startswith('"'), F.replace(t.substr(F.lit(2), F.length(t) - 2), F.lit('""'), F.lit('"'))).otherwise(t),
        F.lit(_ESCAPE + "e"), F.lit(_ESCAPE)))
    # a line without a quote is cut at every comma
    return F.when(~line.contains('"'), F.split(line, ",", -1)).when(whole, fields)


def token(tokens, i: int) -> Column:
    """0-based token access; NULL when the line has too few tokens."""
    return F.get(_col(tokens), i)


def strict_long(s) -> Column:
    """Like a strict integer parse: no spaces, no decimals; NULL otherwise."""
    s = _col(s)
    return F.when(s.rlike(INTEGER_PATTERN), s.try_cast("long"))


def strict_int(s) -> Column:
    s = _col(s)
    return F.when(s.rlike(INTEGER_PATTERN), s.try_cast("int"))


def to_double(s) -> Column:
    """Floating-point parse; NULL when the text is not a number."""
    return _col(s).try_cast("double")


def last_field(line) -> Column:
    """Text after the last comma (the whole line when there is none)."""
    return F.substring_index(_col(line), ",", -1)
