"""Operators for large training-data pipelines.

Ten operators, one module each, plus their registered queries
(``queries.py``) and DuckDB statements (``oracle.py``). Nothing outside this
package imports it; ``__spark_entry__.py`` adds the queries if it is present.
"""
