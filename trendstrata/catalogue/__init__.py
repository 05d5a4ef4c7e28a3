"""Every operator as a named query over the test tables, with its SQL oracle."""

from trendstrata.catalogue.oracles import ORACLES
from trendstrata.catalogue.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
