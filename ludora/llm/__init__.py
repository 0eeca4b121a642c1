"""Training-data operators (numbered 1 to 13) and their registered queries.

Nothing outside this subpackage imports it; `__spark_entry__.py` adds its
queries only when it can be imported.
"""
