"""Payments medallion analytics on Spark: five rails, four layers, one set of DataFrame operators."""

__version__ = "0.1.0"
