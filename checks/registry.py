"""All registered queries; importing the modules registers them."""

from . import datasets, datasets_oncology, operators  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
