"""Training-data operators: scoring, filtering, archiving, mixing and sharding of text corpora.

Nothing outside this subpackage imports it.  Every operator takes DataFrames and returns
DataFrames; the digest queries that the entry point registers are in ``queries``.
"""
