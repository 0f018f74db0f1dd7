"""Operators: DataFrame in, DataFrame out, or a named table brought to a new state."""
