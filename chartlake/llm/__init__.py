"""Operators for preparing language-model training data.

Nothing else in the package imports this subpackage; ``__spark_entry__.py``
adds its queries when it is there. Every operator takes and returns
DataFrames; the thin ``opN_<name>`` queries are in :mod:`.queries`.
"""
