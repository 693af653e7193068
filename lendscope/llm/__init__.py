"""Operators for preparing training data at scale.

Nothing else in the library imports this subpackage; ``__spark_entry__``
registers its queries only where it is present.
"""
