"""The registered queries and, where SQL can say the same, their oracle text."""

from .registry import ORACLES, QUERIES
from . import models, data, features, quality, evaluation, monitoring, segments, training, chain  # noqa: F401  (they register)

__all__ = ["ORACLES", "QUERIES"]
