"""Market analytics on Spark: staging, daily marts, snapshots, star schema, checks."""

__version__ = "0.1.0"
