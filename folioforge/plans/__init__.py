"""All registered queries."""

from . import audit, doubts, forms, pages, readings, sources, structure, votes  # noqa: F401
from .registry import CATALOGUE  # noqa: F401
