"""Channel and video statistics on Spark: landing documents, curated rows, reports."""

__version__ = "0.1.0"
