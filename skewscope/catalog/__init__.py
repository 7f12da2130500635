"""Registered queries over the test tables, each with its DuckDB oracle where SQL can say it.

Every query reads whole tables (or frames Spark derives from them); none uses a
row cap, id subset or sample to stay cheap.
"""

from skewscope.catalog._registry import ORACLE_SQL, QUERIES
from skewscope.catalog import (  # noqa: F401  (registers queries)
    exact,
    metrics,
    models,
    prepare,
    recurring,
    sampling,
    selection,
    sources,
    splitting,
)
from skewscope.catalog.flagship import flagship

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]
