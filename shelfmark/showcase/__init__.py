"""Every operator on the sample tables, each with the SQL it must agree with."""

from .oracle import ORACLE
from .queries import QUERIES, flagship

__all__ = ["ORACLE", "QUERIES", "flagship"]
