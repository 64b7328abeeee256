"""Compositions of operators: the feature mart and the driver queries."""
