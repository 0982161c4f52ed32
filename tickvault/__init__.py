"""tickvault: a Spark-native layered daily-price warehouse.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark's
built-in column expressions, so Catalyst can push filters and prune columns,
and the same code runs in batch and inside streaming micro-batches.
"""

__version__ = "0.1.0"
