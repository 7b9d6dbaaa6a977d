"""Training-data operators (ten, each by its own method) on Spark DataFrames.

Nothing else in the library imports this package."""
