"""tradeflow: sales-distribution ETL and analytics as Spark DataFrame jobs.

Layers
------
functions/  column expressions (blank tests, defaults, tax split, measures)
operators/  DataFrame operators (lookups, anti joins, latest-per-key, pivots,
            bonus aggregates, windows, unions)
sources/    readers, declared schemas, staged sinks
plans/      end-to-end jobs (invoice lines, order tracking, sell-out, vehicle
            load, workplace settings, sales mart) and the test-data catalog
streaming/  incremental sell-out ingest on Structured Streaming
"""

__version__ = "0.1.0"
