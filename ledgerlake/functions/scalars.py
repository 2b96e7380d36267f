"""Null-safe scalar expressions for cleaning staged report text (Column -> Column).

Every function returns a built-in Spark expression, so it stays inside
whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col

# The characters Python's ``str.strip()`` removes (``str.isspace``).
# Spark's ``trim`` removes only U+0020, and Java's ``\s`` misses U+001C-U+001F and
# the Unicode spaces, so the class is spelled out. ``\x{..}`` is understood by
# both Java regex and RE2 (the oracle engine).
WHITESPACE_CLASS = (
    r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
_EDGE_WS = f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$"


def strip(c) -> Column:
    """Remove whitespace at both ends, like Python ``str.strip()``."""
    return F.regexp_replace(col(c), _EDGE_WS, "")


def has_edge_whitespace(c) -> Column:
    """True when ``strip`` would change the value."""
    return col(c).rlike(_EDGE_WS)


def has_text(c) -> Column:
    """``length(strip(c)) > 0``, decided by finding one non-whitespace character
    (stops at the first one instead of rewriting the whole text)."""
    return col(c).rlike("[^" + WHITESPACE_CLASS[1:])


def blank_to_null(c) -> Column:
    """Stripped text, or NULL when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def safe_pct(num, den) -> Column:
    """``num / den * 100``; NULL when the denominator is 0 or NULL (never inf/error)."""
    num, den = col(num), col(den)
    return F.when(den != 0, num.cast("double") / den.cast("double") * F.lit(100.0))


def safe_ratio(num, den) -> Column:
    """``num / den``; NULL when the denominator is 0 or NULL."""
    num, den = col(num), col(den)
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def strict_number(c, dtype: str = "double") -> Column:
    """ANSI cast: malformed text (``''``, ``'12.0'`` to int) raises instead of NULL."""
    return col(c).cast(dtype)


def required_number(c, dtype: str = "double", what: str = "value") -> Column:
    """Strict parse that also rejects a missing value (an empty cell fails the job)."""
    parsed = col(c).cast(dtype)
    return F.coalesce(parsed, F.raise_error(F.lit(f"missing {what}")).cast(dtype))


def lenient_number(c, dtype: str = "double") -> Column:
    """Blank text is NULL; anything else must parse strictly."""
    return blank_to_null(c).cast(dtype)


def to_bool(c) -> Column:
    """``strip().lower() == 'true'``; any other text, and NULL, is False."""
    return F.coalesce(F.lower(strip(c)) == F.lit("true"), F.lit(False))


def remaining(budget, spent) -> Column:
    return col(budget) - col(spent)


def round6(c) -> Column:
    return F.round(col(c), 6)
