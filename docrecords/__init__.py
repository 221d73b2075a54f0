"""docrecords: document collections to clean, typed invoice records, on Spark.

Every public operator is a ``DataFrame -> DataFrame`` function (or a column
expression builder), so the same code runs in batch and in Structured Streaming.
"""

__version__ = "0.1.0"
