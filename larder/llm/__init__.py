"""Operators for preparing training data: one module per operator.

Nothing outside this subpackage imports it; ``queries.py`` lists the queries
that the repository's entry file registers when the subpackage is present.
"""
