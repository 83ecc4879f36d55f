"""Dotted JSON path -> Column expression.

Path syntax (dot separated steps):

* ``name``   - field of an object (struct field / map key); a missing key
  yields NULL.
* ``[i]``    - element ``i`` (0-based) of a list; out of range yields NULL.
* ``[*]``    - every element of a list; the rest of the path is applied to
  each element (``transform``), so ``[*].[*].x`` gives a list of lists.
* ``[a:b]``  - elements ``a`` (inclusive) to ``b`` (exclusive); either bound
  may be omitted.

A list step that is not one of the bracket forms raises ``ValueError('Not a
valid path')`` at plan time; a bracket step applied to an object yields NULL
(an object has no key named ``[..]``).

The compiler walks the column's *schema*, so everything becomes built-in
expressions (``getField``, ``get``, ``slice``, ``transform``) evaluated in the
JVM; JSON text columns are parsed once with ``from_json`` and a declared
schema.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BRACKET = re.compile(r"^\[(.+)\]$")
_SLICE = re.compile(r"^(\d*):(\d*)$")


class PathError(ValueError):
    pass


def _steps(path: str) -> list[str]:
    if path is None or path == "":
        return []
    return path.split(".")


def _walk(c: Column, dtype: T.DataType, steps: list[str]) -> tuple[Column, T.DataType]:
    if not steps:
        return c, dtype
    step, rest = steps[0], steps[1:]
    m = _BRACKET.match(step)
    if isinstance(dtype, T.ArrayType):
        if m is None:
            raise PathError("Not a valid path")
        inner = m.group(1)
        et = dtype.elementType
        if inner == "*":
            return _map_rest(c, et, rest)
        sm = _SLICE.match(inner)
        if sm:
            lo = int(sm.group(1)) if sm.group(1) else 0
            if sm.group(2):
                hi = int(sm.group(2))
                length = F.lit(max(hi - lo, 0))
            else:
                length = F.greatest(F.size(c) - F.lit(lo), F.lit(0))
            return _map_rest(F.slice(c, F.lit(lo + 1), length), et, rest)
        if not inner.isdigit():
            raise PathError("Not a valid path")
        return _walk(F.get(c, F.lit(int(inner))), et, rest)
    if isinstance(dtype, T.StructType):
        if m is not None or step not in dtype.fieldNames():
            return F.lit(None).cast("string"), T.StringType()
        return _walk(c.getField(step), dtype[step].dataType, rest)
    if isinstance(dtype, T.MapType):
        if m is not None:
            return F.lit(None).cast("string"), T.StringType()
        return _walk(F.try_element_at(c, F.lit(step)), dtype.valueType, rest)
    # scalar reached but path continues -> no such key
    return F.lit(None).cast("string"), T.StringType()


def _map_rest(arr: Column, et: T.DataType, rest: list[str]) -> tuple[Column, T.DataType]:
    if not rest:
        return arr, T.ArrayType(et)
    # derive the result type once from a probe walk on a typed placeholder
    holder = {}

    def fn(x):
        col, dt = _walk(x, et, rest)
        holder["dt"] = dt
        return col

    out = F.transform(arr, fn)
    return out, T.ArrayType(holder.get("dt", T.StringType()))


def json_path(col, path: str, dtype: T.DataType | None = None,
              schema: T.DataType | str | None = None) -> Column:
    """Compile ``path`` against a column.

    ``dtype`` is the column's type (e.g. ``df.schema['doc'].dataType``).
    For a JSON *text* column pass ``schema`` instead; it is parsed with
    ``from_json`` first.
    """
    c = F.col(col) if isinstance(col, str) else col
    if schema is not None:
        if isinstance(schema, str):
            schema = T._parse_datatype_string(schema)
        c = F.from_json(c, schema)
        dtype = schema
    if dtype is None:
        raise ValueError("json_path needs the column type (dtype) or a JSON schema")
    out, _ = _walk(c, dtype, _steps(path))
    return out


def json_path_df(df, col: str, path: str) -> Column:
    """Convenience: compile a path against ``df[col]`` using its schema."""
    return json_path(df[col], path, df.schema[col].dataType)

