"""campuswatt: building-energy data on Spark.

Operators take and return lazy DataFrames; ``plans`` strings them into jobs.
"""
