"""Column expressions (all built-in Spark functions, no per-row Python)."""

from .calendar import (  # noqa: F401
    date_natural_key, fiscal_quarter, fiscal_year_be, fiscal_year_ce,
    fiscal_year_natural_key, format_era_date, is_month_end, parse_era_date,
    report_file_name,
)
from .scalars import (  # noqa: F401
    blank_to_null, has_edge_whitespace, lenient_number, remaining, round6,
    safe_pct, safe_ratio, strict_number, strip, to_bool,
)
from .web import (  # noqa: F401
    base_name, call_arg, decode_entities, has_file_link, hrefs, page_lang,
    preview, resolve_url, sha256_hex, site_root, strip_tags, text_nodes,
)
