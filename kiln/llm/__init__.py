"""Operators for preparing language-model training data at corpus scale.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries when it can be imported.  Each operator is a module with a general
interface; ``queries`` binds the operators to the given tables.
"""
