"""Operators for training-data pipelines; nothing else in the library imports this subpackage.

Python workers import these modules, so on a cluster ship the package with `--py-files`
(or install it on the executors).
"""
