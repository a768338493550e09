"""Dated asset panels on Spark: keyed updates, as-of joins, index universes, factor covariances."""
