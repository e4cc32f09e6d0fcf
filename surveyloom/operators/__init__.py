"""Operators: DataFrame in, DataFrame out, driven by the specs."""
