"""Labour-movement analytics as PySpark DataFrame plans.

One row of the fact table is one hiring (+1) or one dismissal (-1). The package
reads monthly files whose columns drift, decodes and enriches them, cleans them
with an account of every rejected row, derives period columns and answers
balance questions over the result. Functions take and return DataFrames.
"""
