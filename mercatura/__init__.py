"""Commerce reporting on Spark: load, clean, profile, aggregate and rank order data."""

from mercatura.schema import Tables
from mercatura.session import tune

__all__ = ["Tables", "tune"]
