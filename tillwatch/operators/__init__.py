"""Batch operators, ``f(df, ...) -> DataFrame``."""
