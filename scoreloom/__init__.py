"""Item-rating analytics as plain PySpark: DataFrames in, DataFrames out.

Nothing in this package collects data to the driver, uses RDDs or runs a
Python UDF: every operator is a declarative plan that Catalyst may rewrite.
"""
