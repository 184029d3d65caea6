"""Analytics operators and ready-made queries written as Spark DataFrame plans."""

__version__ = "0.1.0"
