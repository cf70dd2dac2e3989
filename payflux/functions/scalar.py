"""Scalar functions of the reference dialect, as built-in Spark expressions.

All of them stay JVM-side (whole-stage codegen); none is a Python UDF.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def str_concat(*cols) -> Column:
    """``str:concat``: NULL in any argument gives NULL (kept, as in Spark)."""
    return F.concat(*[c if isinstance(c, Column) else F.lit(c) for c in cols])


def str_contains(col, sub: str) -> Column:
    """``str:contains(s, sub)``."""
    return F.contains(_c(col), F.lit(sub))


def convert(col, to: str) -> Column:
    """``convert(x, 'string'|'long'|'double')`` as an ANSI cast.

    double -> long truncates toward zero, like the reference's conversion.
    """
    target = {"string": "string", "long": "bigint", "double": "double",
              "int": "int", "bool": "boolean"}[to]
    return _c(col).cast(target)


def if_then_else(cond: Column, a, b) -> Column:
    """``ifThenElse(c, a, b)``; a NULL condition takes the else arm."""
    return F.when(cond, a).otherwise(b)


def get_null(type_name: str = "string") -> Column:
    """``getNull('string')``."""
    return F.lit(None).cast(type_name)


def epoch_millis(ts_col) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ, independent of the session zone."""
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, {_name(ts_col)}) div 1000")


def current_time_millis() -> Column:
    """``currentTimeMillis()``: fixed per query (per micro-batch in streaming)."""
    return F.unix_millis(F.current_timestamp())


def json_get_string(col, path: str) -> Column:
    """``json:getString(obj, '$.p')``; also reads single-quoted JSON."""
    return F.get_json_object(_c(col), path)


def json_get_double(col, path: str) -> Column:
    return F.get_json_object(_c(col), path).cast("double")


def json_get_long(col, path: str) -> Column:
    return F.get_json_object(_c(col), path).cast("bigint")


def json_to_map(col) -> Column:
    """``json:toObject`` / ``map:createFromJSON``: a JSON object as map<string,string>."""
    return F.from_json(_c(col), "map<string,string>")


def json_to_variant(col) -> Column:
    """``json:toObject`` of strict JSON with nested values kept (NULL where the text is no strict JSON)."""
    return F.try_parse_json(_c(col))


def object_get(obj, path: str, kind: str = "string") -> Column:
    """A value of a variant object by path; NULL where it is absent or of another kind."""
    return F.try_variant_get(_c(obj), path, kind)


def object_json(obj, path: str = "$") -> Column:
    """A part of a variant object as JSON text (its fields in alphabetical order)."""
    return F.to_json(F.try_variant_get(_c(obj), path, "variant"))


def map_remove(map_col, key: str) -> Column:
    """``map:remove(m, k)``."""
    return F.map_filter(map_col, lambda k, v: k != F.lit(key))


# a prime just below the reference's range of settlement ids (rand() * 999999999999999)
SETTLEMENT_IDS = 999_999_999_999_989


def settlement_id(col, multiplier: int = 48271) -> Column:
    """Settlement id in [1, SETTLEMENT_IDS] from an integer column, instead of a random one.

    Multiplication modulo a prime is one to one, so ids below it never collide;
    the product is a decimal, so it cannot overflow.
    """
    p = F.lit(SETTLEMENT_IDS).cast("decimal(20,0)")
    x = F.pmod(_c(col).cast("decimal(20,0)"), p) * F.lit(multiplier).cast("decimal(10,0)")
    return (F.pmod(x, p) + 1).cast("bigint")


def rand(col, seed: str = "") -> Column:
    """``math:rand()`` as a reproducible draw in [0, 1): 52 bits of a hash of the seed and a row's key."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), _c(col).cast("string")).cast("binary"))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / float(1 << 52)


_TOKEN = re.compile(r"\{\{\s*([A-Za-z_][A-Za-z0-9_]*)\s*\}\}")


def render_template(template: str) -> Column:
    """``map.payload='{{status}}'``: a payload template as one concat expression.

    The template is configuration (a driver-side string), the values are columns;
    NULL fields render as the empty string.
    """
    parts, pos = [], 0
    for m in _TOKEN.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(F.coalesce(F.col(m.group(1)).cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")


def _c(col) -> Column:
    return col if isinstance(col, Column) else F.col(col)


def _name(col) -> str:
    if isinstance(col, str):
        return f"`{col}`"
    raise TypeError("epoch_millis takes a column name")
