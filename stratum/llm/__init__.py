"""Operators for preparing training data at corpus scale.

Nothing else in the library imports this subpackage; its queries are added to
``__spark_entry__.queries()`` only when it can be imported.
"""
