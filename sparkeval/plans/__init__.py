"""Named queries over the input tables, each with the SQL that checks it."""

from sparkeval.plans.registry import ORACLES, QUERIES  # noqa: F401
