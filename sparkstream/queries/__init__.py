"""The registered queries. Importing this package fills the registry."""

from sparkstream.queries import basics, changes, joins, patterns, streams, timewindows  # noqa: F401
from sparkstream.queries.registry import ORACLES, QUERIES  # noqa: F401
