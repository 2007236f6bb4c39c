"""Every operator as a query over the given tables."""

from areaflow.queries import builds, dashboards, feeds, increments, marts, rows, scalars, scans, streams, writes  # noqa: F401
from areaflow.queries.registry import ORACLES, QUERIES  # noqa: F401
