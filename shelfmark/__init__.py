"""Shelfmark: catalog mining as Spark jobs over tables of already-fetched shop pages."""

__version__ = "0.1.0"
