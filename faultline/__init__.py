"""faultline: machine-sensor fault analytics on Spark.

Trailing-window training tables, latest-window materialisation into a keyed
feature table with expiry, Structured Streaming windows and keyed state,
key and as-of lookups, temporal splits, Spark ML training and scoring.
"""

__version__ = "0.1.0"
