"""Named queries over the given tables, with their SQL oracles."""

from scholarmill.plans import (describe, features, models, one_feature, quality, scored,  # noqa: F401
                               sources, streams)
from scholarmill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
