"""Training-data operators on DataFrames: packing, scans, dedup, classifiers.

Nothing outside this subpackage imports it.  Every module holds one operator;
``queries`` registers them.
"""
