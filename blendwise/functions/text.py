"""Text predicates and rewrites.

The warehouse operator ``~*`` is an unanchored, case-insensitive regex match.
It maps to ``rlike('(?i)' + pattern)``, which runs inside whole-stage codegen.
NULL input gives NULL, so a filter drops the row in both the positive and the
negated form, exactly as in the warehouse.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from blendwise.functions.columns import as_col


def imatch(c, pattern: str, literal: bool = False) -> Column:
    """``c ~* pattern``. With ``literal=True`` the pattern is matched as plain text."""
    p = re.escape(pattern) if literal else pattern
    return as_col(c).rlike("(?i)" + p)


def not_imatch(c, pattern: str, literal: bool = False) -> Column:
    """``c !~* pattern`` (NULL stays NULL)."""
    return ~imatch(c, pattern, literal)


def any_imatch(c, patterns, literal: bool = False) -> Column:
    """``c ~* p1 OR c ~* p2 ...``."""
    cond = None
    for p in patterns:
        term = imatch(c, p, literal)
        cond = term if cond is None else (cond | term)
    return cond


def replace_all(c, pairs) -> Column:
    """Nested literal ``REPLACE`` calls, applied in order."""
    out = as_col(c)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def split_part(c, delimiter: str, n: int = 1) -> Column:
    """``SPLIT_PART(c, delimiter, n)``; the whole string if the delimiter is absent."""
    return F.split_part(as_col(c), F.lit(delimiter), F.lit(n))


def as_text(c) -> Column:
    """``c::varchar``."""
    return as_col(c).cast("string")
