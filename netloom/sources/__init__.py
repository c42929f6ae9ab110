"""Sources and sinks: table collections, multi-table JSON, derived tables."""

from netloom.sources.collection import Collection, load_json  # noqa: F401
from netloom.sources.star import Star  # noqa: F401
