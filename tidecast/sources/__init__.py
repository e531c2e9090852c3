"""Scans, fixture views and sinks."""

from tidecast.sources.tables import INI, TABLES, Fixtures, read_table  # noqa: F401
from tidecast.sources.sinks import (  # noqa: F401
    gather_predictions,
    write_features,
    write_importance,
    write_predictions,
    write_submission,
)
