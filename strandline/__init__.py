"""Strandline: sequence-record, hit-table and count-matrix analytics as Spark DataFrames."""

__version__ = "0.1.0"
