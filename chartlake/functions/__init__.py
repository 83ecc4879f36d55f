"""Column-level functions (built-in Spark expressions only, no Python UDFs)."""

from chartlake.functions.jsonpath import json_path, json_path_df, PathError  # noqa: F401
from chartlake.functions.text import (  # noqa: F401
    build_url, group_concat, html_extract_all, marker_substring, split_list,
    unknown_member, url_from_template, url_host,
)
from chartlake.functions.time import (  # noqa: F401
    coalesce_timestamp, day_of, is_iso_datetime, iso_text, parse_iso, round_to_hour,
    same_day,
)
from chartlake.functions.variantpath import parse as parse_variant  # noqa: F401
from chartlake.functions.variantpath import variant_path  # noqa: F401
