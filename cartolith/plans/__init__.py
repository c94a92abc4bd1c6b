"""The query catalogue. Importing this package registers all queries."""

from . import compositions, coordinates, details, drivers, files, georeference, pipelines, pixels, points, results, stores, strings, text_layer  # noqa: F401
from .catalog import CATALOGUE

__all__ = ["CATALOGUE"]
