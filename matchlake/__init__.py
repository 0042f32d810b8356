"""Match results on Spark: load, check, profile and rank league match data.

Pure functions on DataFrames; the SparkSession and all paths are arguments.
"""

__version__ = "0.1.0"
