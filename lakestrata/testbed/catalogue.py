"""All registered queries."""

from lakestrata.testbed import (queries_operators, queries_profiling, queries_quality, queries_sources,  # noqa: F401
                                queries_warehouse)
from lakestrata.testbed.registry import QUERIES, SQL  # noqa: F401
