"""Operators for preparing training text at scale (each module states its method).

Nothing outside this folder imports it; ``queries.py`` binds the operators to
the driver's tables.
"""
