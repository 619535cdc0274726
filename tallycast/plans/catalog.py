"""All registered queries and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallycast.plans import dated_queries, event_queries, model_queries, series_queries, stream_queries

_MODULES = (event_queries, series_queries, model_queries, stream_queries, dated_queries)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for _module in _MODULES:
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
