"""Event and time-series feature analytics, declared as Spark DataFrame jobs."""

__version__ = "0.1.0"
