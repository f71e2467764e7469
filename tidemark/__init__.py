"""Point-in-time analytics on Spark: merges, histories, parsers and data repair as DataFrame operators."""

__version__ = "0.1.0"
