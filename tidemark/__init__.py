"""Interval analytics expressed as Spark DataFrame plans."""
