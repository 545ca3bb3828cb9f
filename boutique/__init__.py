"""Retail preference engine on Spark: customer and article encoding,
lifespans, preference vectors, segments, clustering and scoring, written as
DataFrame / Spark SQL jobs."""

__version__ = "0.1.0"
