"""DataFrame -> DataFrame operators (lazy; no action, nothing collected)."""

from chartlake.operators.dedupe import dedupe_latest, dedupe_repeated, repeated  # noqa: F401
from chartlake.operators.filters import conjunction, optional_filters  # noqa: F401
from chartlake.operators.frontier import missing_ids, missing_report, request_frontier  # noqa: F401
from chartlake.operators.genres import (  # noqa: F401
    distinct_genres, folded_genres, folded_genres_of, genre_bridge, genres_list, genres_of, same_genre,
    with_folded_genre,
)
from chartlake.operators.nested import explode_fields, explode_one, explode_two, flatten_distinct  # noqa: F401
from chartlake.operators.quality import (  # noqa: F401
    check, fk_orphans, null_counts, rule_counts,
)
from chartlake.operators.snapshot import (  # noqa: F401
    delete_by_keys, delete_child_by_parent_source, delete_snapshot, latest_of_day,
    replace_upsert, snapshot_metadata,
)
