"""Revision-corpus analytics on Spark: composable DataFrame operators over histories of edited texts."""

__version__ = "0.1.0"
