"""Training-data operators: one module an operator, thin queries in ``queries``.

Nothing outside this package imports it.
"""
