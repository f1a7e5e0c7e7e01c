"""Quadrille: a Spark-native spatial item catalogue and table engine."""

__version__ = "0.1.0"
