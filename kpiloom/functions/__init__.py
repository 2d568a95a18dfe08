"""Column-expression helpers, all built from pyspark.sql.functions (JVM-side).

All but ``pg_initcap`` are code-generated.  Its higher-order ``transform`` is
evaluated interpreted, which is why the ingest applies it to the part and
nation rows rather than to every line.  ``stats`` holds the only Python: three
pandas UDFs for already-aggregated rows."""

from kpiloom.functions.text import pg_initcap  # noqa: F401
from kpiloom.functions.dates import (  # noqa: F401
    age_day, month_name, month_start, month_year_label, quarter_label,
    week_start, week_of_year_7day, year_start_on_or_after,
)
from kpiloom.functions.numeric import (  # noqa: F401
    exact_round_div, int_div, line_revenue, round_to_double, trunc_toward_zero,
)
