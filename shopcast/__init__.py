"""shopcast: store-by-day retail panel analytics and forecasting on Spark.

Every operator is a ``DataFrame -> DataFrame`` function (or a pyspark.ml
stage wrapping one). Nothing collects a table to the driver; scalars are
carried as one-row DataFrames and joined back.
"""

from shopcast.session import checkpoint_dir, get_spark, materialize

__all__ = ["get_spark", "checkpoint_dir", "materialize"]
