"""rowforge: batch table operators written as plain DataFrame transformations.

Every operator takes DataFrames and returns a lazy DataFrame, so a job is a
chain of ``DataFrame.transform`` calls that Catalyst plans as one query.
"""
