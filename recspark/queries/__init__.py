"""Named queries over the given tables, one or more per operator."""

from .base import ORACLES, QUERIES
from . import competition, cleaning, encoding, ranking, samples, search, sequences, sources, text

__all__ = ["ORACLES", "QUERIES"]
