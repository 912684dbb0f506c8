"""winnow: screening of bibliographic records as Spark DataFrame jobs."""

__version__ = "0.1.0"
