"""Shelfmark: catalogue-and-review analytics as plain Spark jobs.

Every operator is a function from DataFrames to a DataFrame.  Nothing in the
library collects rows to the driver beyond fixed-size summaries, and no Python
code runs per row.
"""
