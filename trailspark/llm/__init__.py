"""Training-data operators: one module per operator, registered in ``queries``.

Nothing outside this package imports it; removing the folder removes the
operators, their queries and their oracles.
"""
