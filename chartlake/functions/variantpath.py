"""Dotted JSON paths over documents without a declared schema (Variant values).

The steps are those of :mod:`chartlake.functions.jsonpath`; what a step meets
is only known row by row, so what that module checks against the schema is
checked here in the data:

* a name on an object takes its field, a missing key gives NULL;
* ``[i]``, ``[*]`` and ``[a:b]`` on a list as there; on anything else NULL;
* a name on a list fails with ``Not a valid path``.

Everything is built-in expressions; a text is parsed once, by ``parse``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartlake.functions.jsonpath import PathError

_INDEX = re.compile(r"^\[(\d+)\]$")
_MANY = re.compile(r"^\[(?:\*|(\d*):(\d*))\]$")


def parse(text) -> Column:
    """JSON text as a Variant; NULL where it is no JSON."""
    return F.try_parse_json(F.col(text) if isinstance(text, str) else text)


def _list(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _field(value: Column, name: str) -> Column:
    if "'" in name:
        raise PathError(f"a quote in the key {name!r}")
    wrong = F.raise_error(F.lit("Not a valid path")).cast("variant")
    return F.when(_list(value).isNotNull(), wrong).otherwise(F.try_variant_get(value, f"$['{name}']", "variant"))


def _walk(value: Column, steps: list[str], kind: str) -> Column:
    if not steps:
        return value if kind == "variant" else F.try_variant_get(value, "$", kind)
    step, rest = steps[0], steps[1:]
    one, many = _INDEX.match(step), _MANY.match(step)
    if one:
        return _walk(F.get(_list(value), F.lit(int(one.group(1)))), rest, kind)
    if many:
        found = _list(value)
        if step != "[*]":
            low, high = int(many.group(1) or 0), many.group(2)
            n = F.lit(max(int(high) - low, 0)) if high else F.greatest(F.size(found) - F.lit(low), F.lit(0))
            found = F.slice(found, F.lit(low + 1), n)
        return F.transform(found, lambda x: _walk(x, rest, kind))
    if step.startswith("[") and step.endswith("]"):
        raise PathError("Not a valid path")
    return _walk(_field(value, step), rest, kind)


def variant_path(value, path: str | None, kind: str = "string") -> Column:
    """What ``path`` leads to in a Variant column, as ``kind`` (a type, or ``variant``), inside
    one array for each ``[*]`` or slice on the way. A value that isn't of that type gives NULL."""
    return _walk(F.col(value) if isinstance(value, str) else value, path.split(".") if path else [], kind)
