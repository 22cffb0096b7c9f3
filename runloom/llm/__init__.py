"""Training-data operators: deduplication, tokens, language, packing, neighbours.

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames; Python runs only inside Arrow tasks that Spark has partitioned.
"""
