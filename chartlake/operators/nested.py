"""Generators over nested documents.

``explode`` is a narrow operation: it runs inside the scan's stage with no
shuffle, and on parquet input Catalyst prunes the nested read schema to the
fields used after the explode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def explode_one(df: DataFrame, path: str, alias: str, keep: list[str] | None = None,
                position: str | None = None, outer: bool = False) -> DataFrame:
    """One row per element of the array at ``path``.

    NULL or empty arrays drop the row (``outer=True`` keeps it with a NULL
    element). ``position`` adds the 0-based element index - the chart rank.
    """
    keep = [F.col(k) for k in (keep or [])]
    if position:
        gen = F.posexplode_outer(_c(path)) if outer else F.posexplode(_c(path))
        return df.select(*keep, gen.alias(position, alias))
    gen = F.explode_outer(_c(path)) if outer else F.explode(_c(path))
    return df.select(*keep, gen.alias(alias))


def explode_fields(df: DataFrame, path: str, fields: dict[str, str], keep: list[str] | None = None,
                   position: str | None = None, outer: bool = False) -> DataFrame:
    """Explode an array of structs, keeping only the listed leaf fields.

    ``fields`` maps output name -> path inside the element (``track.id``),
    or -> a Column over the whole array for leaves below a second array level
    (e.g. ``transform(items.track.artists, a -> a.id)``).
    Same rows as ``explode_one`` + field selection (a NULL/empty array drops
    the row, a NULL element gives NULL fields), but the leaves are zipped
    from their own arrays (``arrays_zip(items.track.id, ...)``) before the
    explode, so the parquet scan reads only those leaves: Catalyst prunes
    nested columns through a generator only when one field is used.
    """
    keep = [F.col(k) for k in (keep or [])]
    names = list(fields)
    zipped = F.arrays_zip(*[(sub if isinstance(sub, Column) else F.col(f"{path}.{sub}")).alias(n)
                            for n, sub in fields.items()])
    if position:
        gen = (F.posexplode_outer if outer else F.posexplode)(zipped).alias(position, "__z")
        out = df.select(*keep, gen)
        return out.select(*keep, position, *[F.col(f"__z.{n}").alias(n) for n in names])
    gen = (F.explode_outer if outer else F.explode)(zipped).alias("__z")
    return df.select(*keep, gen).select(*keep, *[F.col(f"__z.{n}").alias(n) for n in names])


def explode_two(df: DataFrame, outer: str, inner: str, outer_alias: str, inner_alias: str,
                keep: list[str] | None = None) -> DataFrame:
    """Chained explode: rows x outer elements x inner elements.

    ``inner`` is a path relative to the outer element (e.g. ``track.artists``);
    an outer element whose inner array is NULL/empty vanishes.
    """
    keep = list(keep or [])
    first = explode_one(df, outer, outer_alias, keep)
    return first.select(*keep, outer_alias,
                        F.explode(F.col(f"{outer_alias}.{inner}")).alias(inner_alias))


def flatten_distinct(df: DataFrame, col, alias: str = "value") -> DataFrame:
    """Distinct elements of a list-of-lists column, one row each.

    NULL inner lists are dropped first (``flatten`` would turn the whole row
    NULL). Distinct runs as a partial + final hash aggregate, so duplicates
    are folded map-side before the shuffle.
    """
    nested = F.filter(_c(col), lambda a: a.isNotNull())
    return (df.select(F.explode(F.flatten(nested)).alias(alias))
              .where(F.col(alias).isNotNull())
              .distinct())
