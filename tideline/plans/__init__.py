"""Operators put together: taxi trips to fact and dimension, and the load runs around them."""
