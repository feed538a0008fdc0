"""All registered queries."""

from . import q_dashboard, q_files, q_marts, q_operators, q_quality, q_staging  # noqa: F401
from .spec import REGISTRY

__all__ = ["REGISTRY"]
