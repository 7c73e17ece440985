"""feedkit: recurring data feeds and training-compliance tables on Spark DataFrames."""

__version__ = "0.1.0"
