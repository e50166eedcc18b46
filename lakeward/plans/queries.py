"""All registered queries and their SQL."""

from lakeward.plans import digest_queries, merge_queries, report_queries, scalar_queries, source_queries  # noqa: F401
from lakeward.plans.catalog import ORACLES, QUERIES

FLAGSHIP = "rate_per_100k"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
