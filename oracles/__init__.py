"""SQL that computes every query a second time, for DuckDB on the same tables."""

from oracles.archives import ARCHIVES
from oracles.events import EVENTS
from oracles.tables import TABLES

ORACLES: dict[str, str] = {**ARCHIVES, **EVENTS, **TABLES}
