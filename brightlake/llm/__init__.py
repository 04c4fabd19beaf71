"""Operators for preparing training text at scale.

Nothing else in the library imports this subpackage; ``__spark_entry__``
registers its queries when it can be imported.
"""
