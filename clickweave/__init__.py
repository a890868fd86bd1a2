"""clickweave: session-intent analytics for online-shop clickstreams on Spark.

Every operator is a pure function ``DataFrame -> DataFrame`` (or a small
driver-side value for p x p statistics and fitted-model parameters).
"""

__version__ = "0.1.0"
