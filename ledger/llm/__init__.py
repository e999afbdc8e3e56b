"""Training-data operators: one module per operator, queries in ``queries.py``, SQL twins in ``oracle.py``."""
