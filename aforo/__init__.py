"""aforo: a customs-trade warehouse written as Spark DataFrame jobs."""

__version__ = "0.1.0"
