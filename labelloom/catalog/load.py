"""Imports every query module, so that the registry is full."""

from labelloom.catalog import evaluation, preparation, splitting, texts  # noqa: F401
from labelloom.catalog.registry import ORACLES, QUERIES  # noqa: F401
