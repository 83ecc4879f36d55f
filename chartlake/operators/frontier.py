"""Request frontier and missing-ids report (the data side of the fetch step)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlake.functions.text import url_from_template


def request_frontier(df: DataFrame, id_col, template: str, alias: str = "id") -> DataFrame:
    """Distinct ids -> one request URL each (``template`` holds one ``%s``).

    ``id_col`` may be an array column (all ids of a document); it is exploded
    first. Distinct is a partial/final aggregate: repeats fold map-side.
    """
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    from pyspark.sql import types as T
    dtype = df.select(c).schema[0].dataType
    if isinstance(dtype, T.ArrayType):
        ids = df.select(F.explode(c).alias(alias))
    else:
        ids = df.select(c.alias(alias))
    ids = ids.where(F.col(alias).isNotNull()).distinct()
    return ids.select(alias, url_from_template(template, F.col(alias).cast("string")).alias("url"))


def missing_ids(requested: DataFrame, fetched: DataFrame, key: str,
                fetched_key: str | None = None, run: list[str] | None = None) -> DataFrame:
    """Requested ids that no fetched document carries (set difference); with
    ``run`` columns on both sides, within each run."""
    run = run or []
    fk = fetched_key or key
    req = requested.select(*run, F.col(key).alias(key)).where(F.col(key).isNotNull())
    got = fetched.select(*run, F.col(fk).alias(key)).where(F.col(key).isNotNull())
    return req.join(got, [*run, key], "left_anti").distinct()


def missing_report(missing: DataFrame, key: str, run_col: str, kind: str = "missing_artists") -> DataFrame:
    """Long form of the per-run sentinel: ``(type, id, data_time)`` rows.

    One row per missing id rather than one array per run, so a run with a
    huge miss list is never gathered into a single row or task.
    """
    return missing.select(F.lit(kind).alias("type"), F.col(key).alias("id"),
                          F.col(run_col).alias("data_time"))
