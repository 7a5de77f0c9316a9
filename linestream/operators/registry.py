"""UDF-1 / UDF-2: line transforms looked up by name.

A transform is ``DataFrame → DataFrame``: it keeps every column of the
input and replaces ``value`` with the output line (a JSON document, an
error document, the line itself, or ``""`` for a filtered line). Names match
ignoring case; an unknown name is an error. User transforms may be
registered, including ones built on a ``pandas_udf``.

A name with a dot that is not registered is a path, ``module.attribute`` (the
original loads a class by its name): a class whose objects have ``transform(line)
-> line``, a plain function of a line, or, marked by `of_frames`, a DataFrame
transform. Functions of a line run in Arrow batches on the workers, to which
the module's code is sent with the plan, so they need not have it; a line they
fail on becomes an error document.
"""

from __future__ import annotations

import importlib
import inspect
import json
import sys
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import parse as P
from .geotag import geotag as geotag_op
from .geotag import load_fences

Transform = Callable[..., DataFrame]
_REGISTRY: dict[str, Transform] = {}


def register(name: str, fn: Transform) -> None:
    _REGISTRY[name.lower()] = fn


def of_frames(fn: Transform) -> Transform:
    """Mark a function as a DataFrame transform, for loading by path."""
    fn.of_frames = True
    return fn


def of_lines(make: Callable[..., Callable[[str], str]]) -> Transform:
    """A transform from a plain ``str -> str``: ``make(**settings)`` is called once a
    task and returns the function. A null line, or an exception, gives an error
    document with its reason; a None is a filtered line (``""``)."""
    null_line = P.R_NULL_LINE

    def transform(lines: DataFrame, **settings) -> DataFrame:
        import pandas as pd

        def run(batches):
            fn = make(**settings)

            def one(line):
                if line is None:
                    return json.dumps({"error": null_line})
                try:
                    out = fn(line)
                except Exception as e:  # noqa: BLE001 - the line's own error document
                    return json.dumps({"error": f"{type(e).__name__}: {e}"})
                return "" if out is None else str(out)

            for values in batches:
                yield pd.Series([one(v) for v in values], dtype="object")

        run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        out = F.pandas_udf(run, "string")(F.col("value"))
        return lines.select(*[out.alias(c) if c == "value" else F.col(c) for c in lines.columns])
    return transform


def load(path: str) -> Transform:
    """The transform at ``module.attribute``."""
    module_name, _, attribute = path.rpartition(".")
    try:
        module = importlib.import_module(module_name)
        found = getattr(module, attribute)
    except (ImportError, AttributeError) as e:
        raise ValueError(f"no transform at {path!r}: {e}") from None
    if getattr(found, "of_frames", False):
        return found
    if module_name.partition(".")[0] not in sys.stdlib_module_names:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(module)  # the workers need not have it
    if inspect.isclass(found):
        if not callable(getattr(found, "transform", None)):
            raise ValueError(f"{path!r} has no method transform(line)")
        return of_lines(lambda **settings: found(**settings).transform)
    if not callable(found):
        raise ValueError(f"{path!r} is not callable")
    return of_lines(lambda **settings: (lambda line: found(line, **settings)))


def get(name: str) -> Transform:
    if name.lower() in _REGISTRY:
        return _REGISTRY[name.lower()]
    if "." in name:
        return load(name)
    raise ValueError(f"unknown transform {name!r}; known: {sorted(_REGISTRY)}, or module.attribute")


def apply(name: str, lines: DataFrame, **settings) -> DataFrame:
    return get(name)(lines, **settings)


def _others(lines: DataFrame) -> list[str]:
    return [c for c in lines.columns if c != "value"]


def noop(lines: DataFrame, **_) -> DataFrame:
    """PRJ-8: the line unchanged."""
    return lines


def simfile_doc(lines: DataFrame, **_) -> DataFrame:
    keep = _others(lines)
    typed = P.simfile_typed(lines, keep=keep)
    return typed.select(*keep, P.document(typed, P.SIMFILE_ATTRS).alias("value"))


def faa_doc(lines: DataFrame, zone: str = "UTC", honor_marker: bool = False, **_) -> DataFrame:
    keep = _others(lines)
    typed = P.faa_typed(lines, keep=keep, zone=zone, honor_marker=honor_marker)
    return typed.select(*keep, P.document(typed, P.FAA_ATTRS).alias("value"))


def geotag_doc(lines: DataFrame, fences: DataFrame | None = None, filter: bool = True, fence_path: str | None = None,
               field_name: str | None = None, multiline: bool = True, **kw) -> DataFrame:
    """The geotagging transform. Settings: the fences, as a table (pos, name,
    rings) or as the path of a fence document with the name of the attribute
    that names a fence (``multiline=False``: one feature per line); and
    ``filter``, with which a valid point in no fence gives ``""`` (error rows
    are never filtered, they skip FLT-2)."""
    if fences is None:
        if fence_path is None or field_name is None:
            raise ValueError("geotag needs fences, or fence_path and field_name")
        fences, _errors = load_fences(lines.sparkSession, fence_path, field_name, multiline)
    keep = _others(lines)
    typed = P.simfile_typed(lines, keep=keep)
    tagged = geotag_op(typed, fences, **kw)
    out = P.document(tagged, [*P.SIMFILE_ATTRS, "geotag"])
    if filter:
        out = F.when(F.col("error").isNull() & (F.col("geotag") == ""), F.lit("")).otherwise(out)
    return tagged.select(*keep, out.alias("value"))


register("NOOP", noop)
register("simfile", simfile_doc)
register("faa", faa_doc)
register("geotag", geotag_doc)


def drop_empty(out: DataFrame) -> DataFrame:
    """FLT-1: forward only non-empty lines."""
    return out.where(F.length("value") > 0)
