"""Urban-mobility analytics on Spark: messy city open data in, DataFrames out."""

__version__ = "0.1.0"
