"""Every operator as a query over the given tables, with the SQL that must give the same rows."""

from loamlens.queries import (  # noqa: F401  (importing a module registers its queries)
    aggregates, cleaning, diagnostics, encoding, imputation, joins, matching, modelling,
    neighbours, spatial, splits)
from loamlens.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
