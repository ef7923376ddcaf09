"""Palisade: hybrid signature + ensemble detection over large labelled tables, on Spark."""

__version__ = "0.1.0"
