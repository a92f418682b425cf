"""Table-level Spark operators that harmonise open data from many publishers.

Every operator takes DataFrames and returns a lazy DataFrame, so Catalyst sees
one logical plan from the raw tables to the published result.
"""
