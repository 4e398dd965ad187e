"""Corpus-scale processing of recorded talks on Spark DataFrames."""

__version__ = "0.1.0"
