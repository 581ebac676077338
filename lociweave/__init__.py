"""Interval evidence, annotation lift and large-corpus preparation on Apache Spark DataFrames."""
