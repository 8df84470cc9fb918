"""Operators for large training-data pipelines (text scoring, filtering, dedup).

Each module holds one operator with a general interface; ``queries`` derives
the registered ``opN_<name>`` results from them.  Nothing outside this
subpackage imports it.
"""
