"""Sources and sinks: CSV loaders (S1, S2), table writes, and adapters that
derive the two analysis inputs from the star-schema tables."""

from kpiloom.sources.files import load_sales, load_visits, write_table  # noqa: F401
from kpiloom.sources.tables import read_table, sales_from_tables, visits_from_events  # noqa: F401


def register_views(*args, **kwargs):
    """See kpiloom.sources.views.register_views."""
    from kpiloom.sources.views import register_views as _register
    return _register(*args, **kwargs)
