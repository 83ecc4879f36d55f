"""Storage: the raw landing zone and the partitioned warehouse."""

from chartlake.sources.landing import land, read_raw, require_rows  # noqa: F401
from chartlake.sources.warehouse import (  # noqa: F401
    drop_snapshot, load_snapshot, read_table, rewrite_table, write_snapshot,
)
