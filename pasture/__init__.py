"""pasture — Spark-native telemetry ingestion, data-quality and analytics.

Everything is expressed with the DataFrame / SQL API so that Catalyst plans
the work: ingestion is one column-expression select per dataset, loads are
key-partitioned aggregations, analytics are grouped moments.
"""

__version__ = "0.1.0"
