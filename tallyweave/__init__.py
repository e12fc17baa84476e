"""Entity scoring and profit-share analytics as DataFrame-to-DataFrame jobs on Spark."""

__version__ = "0.1.0"
