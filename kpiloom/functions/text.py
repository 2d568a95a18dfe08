"""Text functions with PostgreSQL semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a maximal run of letters or digits; everything between words is
# kept unchanged.  This is how PostgreSQL's initcap splits text, whereas
# Spark's initcap splits on spaces only ("HAND-WARMER" -> "Hand-warmer").
_RUNS = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def pg_initcap(col: Column | str) -> Column:
    """First character of every alphanumeric run upper-cased, the rest lower."""
    c = F.col(col) if isinstance(col, str) else col
    runs = F.regexp_extract_all(c, F.lit(_RUNS), 0)
    capped = F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                  F.lower(F.substring(w, 2, 1 << 30))))
    return F.array_join(capped, "")
