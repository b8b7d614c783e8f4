"""Build and maintain partitioned tables from SQL on Spark."""

from partloom.operators import *  # noqa: F403
from partloom.operators import __all__ as _operators

__all__ = list(_operators)
