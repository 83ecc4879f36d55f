"""String / URL / HTML column functions, all as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartlake.schemas import UNKNOWN_ARTIST


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unknown_member(col, label: str = UNKNOWN_ARTIST) -> Column:
    """NULL id -> the unknown-member label.

    The id is cast to string first: a numeric id column would otherwise ignore
    a string fill value and keep its NULLs.
    """
    return F.coalesce(_c(col).cast("string"), F.lit(label))


def build_url(url, params) -> Column:
    """Append query parameters to a URL.

    ``params`` is a ``map<string,string>`` column (or a python dict of
    literals); entries keep map order; values are not escaped. Separator is
    ``?`` when the URL has no query yet, ``&`` when it has one, none when it
    already ends in ``?``/``&``. A ``#fragment`` stays at the end. An empty
    or NULL map leaves the URL unchanged.
    """
    if isinstance(params, dict):
        kv = []
        for k, v in params.items():
            kv += [F.lit(str(k)), v if isinstance(v, Column) else F.lit(str(v))]
        params = F.create_map(*kv) if kv else F.create_map().cast("map<string,string>")
    u = _c(url)
    has_frag = F.instr(u, "#") > 0
    base = F.when(has_frag, F.substring_index(u, "#", 1)).otherwise(u)
    # fragment = everything from the first '#'
    frag = F.when(has_frag, F.substring(u, F.instr(u, "#"), F.length(u))).otherwise(F.lit(""))
    query = F.array_join(
        F.transform(F.map_entries(params), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "&")
    sep = (F.when(base.endswith("?") | base.endswith("&"), F.lit(""))
           .when(F.instr(base, "?") > 0, F.lit("&"))
           .otherwise(F.lit("?")))
    empty = F.coalesce(F.size(params), F.lit(0)) <= 0
    return F.when(empty, u).otherwise(F.concat(base, sep, query, frag))


def url_from_template(template: str, *cols) -> Column:
    """``format_string`` over a ``%s`` template (one row -> one request URL)."""
    return F.format_string(template, *[_c(c) for c in cols])


def html_extract_all(col, pattern: str, group: int = 1) -> Column:
    """All regex matches (capture ``group``) in a text, as an array."""
    return F.regexp_extract_all(_c(col), F.lit(pattern), F.lit(group))


def marker_substring(col, marker: str, width: int) -> Column:
    """Fixed-width text right after the first occurrence of ``marker``.

    NULL when the marker is absent (instead of slicing from position -1).
    """
    c = _c(col)
    pos = F.instr(c, marker)
    return F.when(pos > 0, F.substring(c, pos + F.lit(len(marker)), F.lit(width)))


def url_host(url) -> Column:
    """Host part of an absolute URL (scheme://host[:port]...)."""
    return F.regexp_extract(_c(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)


def split_list(col, sep: str = ",") -> Column:
    """Comma string -> array; NULL (no members) -> empty array, not an error."""
    c = _c(col)
    return F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(F.split(c, sep))


def group_concat(col, sep: str = ",", distinct: bool = True) -> Column:
    """Aggregate: sorted, NULL-skipping concatenation; NULL when all are NULL.

    Deterministic (sorted) unlike a server-side GROUP_CONCAT, and without a
    length cap.
    """
    coll = F.collect_set(_c(col)) if distinct else F.collect_list(_c(col))
    arr = F.array_sort(coll)
    return F.when(F.size(arr) > 0, F.array_join(arr, sep))
