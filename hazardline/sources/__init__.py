"""Sources (operational tables, derived fixtures, freshness) and sinks."""

from hazardline.sources.tables import Sources, timezones_frame  # noqa: F401
from hazardline.sources.fixtures import fixture_sources  # noqa: F401
