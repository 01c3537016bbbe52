"""Operators for large-scale training-data preparation.

Nothing else in the package imports this subpackage.  ``queries`` and
``oracle_sql`` list the driver's queries; each operator has a module.
"""
