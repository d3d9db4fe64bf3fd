"""strata — layered (bronze → silver → gold) batch data work as Spark operators.

Every operator is a ``DataFrame → DataFrame`` function (or returns a small
tuple of DataFrames) built from Spark's own expressions, so Catalyst sees
one declarative plan per output and can push filters, prune columns and
plan two-phase aggregates on its own.
"""

__version__ = "0.1.0"
