"""All record queries and their SQL."""

from payscope.plans.queries import ORACLES, QUERIES  # noqa: F401
from payscope.sources import queries  # noqa: F401  adds its own to the two tables
