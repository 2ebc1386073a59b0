"""Retail lakehouse operators for Spark: every operator takes DataFrames and explicit
parameters and returns a DataFrame; Spark partitions, shuffles and runs the work."""
