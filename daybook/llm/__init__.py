"""Operators for preparing language-model training text at scale.

One module per operator; ``queries.py`` registers them and ``oracle.py`` holds
the DuckDB SQL for those that SQL can express. Nothing outside this package
imports it, apart from the guarded import in ``__spark_entry__.py``.
"""
