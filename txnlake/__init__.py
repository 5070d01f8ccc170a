"""txnlake: a mobile-money transaction lake on PySpark.

Layers: Bronze (landed rows), Silver (deduplicated, quality-flagged, enriched),
Gold (daily / merchant marts, fraud flags, reports). Every operator is a
``DataFrame -> DataFrame`` (or ``-> Column``) function; ``plans.jobs`` runs them
over stored, date-partitioned parquet layers and ``streaming.landing`` feeds
Bronze and Silver incrementally.
"""

__version__ = "0.1.0"
