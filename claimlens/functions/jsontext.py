"""Render string arrays exactly like Python ``json.dumps(list)``.

``to_json`` prints ``["a","b"]`` and keeps non-ASCII characters; the original
files use ``["a", "b"]`` with ASCII escapes (``\\u00e9``, surrogate pairs for
astral characters).  Sink-side only.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SIMPLE_ESCAPES = (('"', '\\"'), ("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"),
                   ("\b", "\\b"), ("\f", "\\f"))


def _escape_char(c: Column) -> Column:
    out = None
    for raw, esc in _SIMPLE_ESCAPES:
        out = F.when(c == F.lit(raw), F.lit(esc)) if out is None else out.when(c == F.lit(raw), F.lit(esc))
    return (out.when(c.rlike(r"^[\x20-\x7e]$"), c)
               .otherwise(F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", "\\\\u$1")))


def json_string(x: Column) -> Column:
    plain = F.concat(F.lit('"'), F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')),
                     F.lit('"'))
    slow = F.concat(F.lit('"'), F.array_join(F.transform(F.regexp_extract_all(x, F.lit("(?s)."), 0), _escape_char),
                                             ""), F.lit('"'))
    return F.when(x.isNull(), F.lit("null")).when(x.rlike(r"^[\x20-\x7e]*$"), plain).otherwise(slow)


def json_list_text(arr: Column) -> Column:
    """``json.dumps(list_of_str)``; a null array renders as ``null``."""
    return F.when(arr.isNull(), F.lit("null")).otherwise(
        F.concat(F.lit("["), F.array_join(F.transform(arr, json_string), ", "), F.lit("]")))


def py_bool_text(b: Column) -> Column:
    """``str(bool).lower()``: true/false, and ``none`` for a missing value."""
    return F.when(b.isNull(), F.lit("none")).when(b, F.lit("true")).otherwise(F.lit("false"))
