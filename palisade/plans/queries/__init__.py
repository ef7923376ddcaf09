"""Every operator as a query over the given tables, with its SQL twin where SQL can express it."""

from palisade.plans.queries import detecting, estimates, holding, preparing, tables, wide  # noqa: F401  (they register themselves)
from palisade.plans.queries.registry import QUERIES, TWINS

__all__ = ["QUERIES", "TWINS"]
