"""idloom: entity resolution and graph canonicalization on Spark DataFrames."""

__version__ = "1.0.0"
